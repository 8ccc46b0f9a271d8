"""Field extraction: rule tables to one Spark projection over pages.

Rules that read metas, embedded JSON, scripts or patterns become column
expressions and stay in the JVM. Rules with a path selector are evaluated
together in one Arrow function that gets only the page text, parses it once and
gives back one string for each selector.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQueryListener

from pageloom.functions import cleaning as K, embedded as E, html as H, urls as U
from pageloom.operators.dom import Page, compile_path, css_to_path
from pageloom.session import small_batches

FIELD_TYPES = {
    "list_price": K.PRICE, "selling_price": K.PRICE, "discount_percentage": "int", "rating": "double",
    "num_reviews": "bigint", "review_count": "bigint", "sizes_count": "int",
}
DOM_RESULT = T.StructType().add("values", T.ArrayType(T.StringType())).add("errors", T.ArrayType(T.StringType()))
DOM_KINDS = {"xpath", "css", "python"}


@dataclass(frozen=True)
class Rule:
    """One candidate for a field. Candidates of a field are tried in table order.

    kind: xpath, css, python | meta, ldjson, next, state, apollo, regex, script, url, column, const | field, discount.
    An apollo rule is a path into the article entity, `path->path` to follow a reference, or `prefix*path`.
    A field rule names another field, or is a function that gives a column over the other fields.
    take: first, first_text (skips blanks), join, count. post: a name in POSTS.
    """

    field: str
    kind: str
    rule: object
    take: str = "first"
    post: str = ""
    sep: str = " "


POSTS: dict[str, Callable[[Column], Column]] = {
    "price": K.parse_price,
    "price_digits": K.parse_price_digits,
    "percent": K.percent_from_text,
    "rating": K.parse_rating,
    "count": K.parse_count,
    "brand": K.clean_brand,
    "title_case": K.title_case,
    "availability": K.availability,
    "color": K.color_from_text,
    "strip_html": H.strip_html,
    "left_500": lambda c: F.left(c, F.lit(500)),
    "truncate": K.truncate_text,
    "no_placeholder": K.placeholder_to_null,
    "sell_of_pair": lambda c: K.price_pair(c)["sell"],
    "list_of_pair": lambda c: K.price_pair(c)["list"],
    "long_text": lambda c: F.when(F.length(c) > 30, c),
}

RULE_SETS: dict[str, list[Rule]] = {}


def register_rule(rule_set: str, rule: Rule) -> None:
    """Add a candidate at the end of a field's chain, as a rule row or with a column function."""
    if rule.kind in ("xpath", "css"):
        compile_path(rule.rule if rule.kind == "xpath" else css_to_path(rule.rule))
    RULE_SETS.setdefault(rule_set, []).append(rule)


def _pick(values: Sequence[str], take: str, sep: str) -> str | None:
    if take == "first":
        return values[0].strip() or None if values else None
    texts = [v.strip() for v in values if v and v.strip()]
    if take == "first_text":
        return texts[0] if texts else None
    if take == "join":
        return sep.join(texts) or None
    if take == "count":
        return str(len(values))
    raise ValueError(f"unknown take {take!r}")


def _dom_function(plan: dict[str, list[Rule]]):
    """plan: the selector rules of each rule set, in slot order."""
    jobs = {
        name: [(r.field, r.kind, css_to_path(r.rule) if r.kind == "css" else r.rule, r.take, r.sep) for r in rules]
        for name, rules in plan.items()
    }

    def one(html: str | None, name: str):
        rules = jobs.get(name, [])
        if not rules or html is None:
            return [None] * len(rules), []
        page, values, errors = Page(html), [], []
        for field, kind, rule, take, sep in rules:
            value = None
            try:
                value = rule(page) if kind == "python" else _pick(page.select(rule), take, sep)
            except Exception as exc:  # a failing rule costs its field only
                errors.append(f"{field}: {type(exc).__name__}")
            values.append(value)
        return values, errors

    @F.pandas_udf(DOM_RESULT)
    def run(html: pd.Series, name: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(h, n) for h, n in zip(html, name)], columns=["values", "errors"])

    return run


class _Sources:
    """Parsed JSON columns shared by all rules of a page."""

    def __init__(self, rules: Sequence[Rule]):
        self.columns: dict[str, Column] = {}
        self.second: dict[str, Column] = {}
        html = F.col("html")
        for r in rules:
            name = self.name(r)
            if not name or name in self.columns:
                continue
            if r.kind == "ldjson":
                self.columns[name] = E.ld_json(html, self.types(r))
            elif r.kind == "next":
                self.columns[name] = F.try_parse_json(E.next_json(html))
            elif r.kind == "state":
                self.columns[name] = F.try_parse_json(E.embedded_state(html, r.rule[0]))
            elif r.kind == "apollo":
                self.columns[name] = E.apollo_cache(html)
                self.second["__entity"] = E.apollo_entity(F.col(name), "LocalNewsArticle")

    @staticmethod
    def types(r: Rule) -> tuple[str, ...]:
        return tuple(r.rule[1:]) or ("Product", "product")

    def name(self, r: Rule) -> str | None:
        """Column that holds the parsed JSON a rule reads."""
        if r.kind == "ldjson":
            return "__ld_" + "_".join(self.types(r))
        if r.kind == "state":
            return f"__state_{r.rule[0]}"
        return {"next": "__next", "apollo": "__cache"}.get(r.kind)

    def broken(self) -> dict[str, Column]:
        """For each parsed JSON column, whether the page carries that JSON in a form that does not parse."""
        html, out = F.col("html"), {}
        for name in self.columns:
            if name.startswith("__ld_"):
                out[name] = E.ld_broken(html)
            elif name.startswith("__state_"):
                out[name] = E.embedded_state(html, name.removeprefix("__state_")).isNotNull() & F.col(f"`{name}`").isNull()
            else:
                out[name] = E.next_json(html).isNotNull() & F.col(f"`{name}`").isNull()
        return {f"__bad{name}": c for name, c in out.items()}

    def value(self, r: Rule) -> Column:
        html = F.col("html")
        if r.kind == "meta":
            return H.meta(html, r.rule)
        source = F.col(f"`{self.name(r)}`")
        if r.kind == "ldjson":
            if r.rule[0].endswith((".author", ".brand")):  # text, object or list of objects
                return K.authors(F.try_variant_get(source, r.rule[0], "variant"))
            return E.field(source, r.rule[0])
        if r.kind == "next":
            return E.field(source, r.rule)
        if r.kind == "state":
            return E.field(source, r.rule[1])
        if r.kind == "apollo":
            entity = F.col("__entity")
            if "->" in r.rule:
                ref, path = r.rule.split("->")
                return E.field(E.apollo_ref(F.col("__cache"), entity, ref), path)
            if "*" in r.rule:
                prefix, path = r.rule.split("*")
                return E.field(E.by_prefix(entity, prefix), path)
            return E.field(entity, r.rule)
        if r.kind == "regex":
            return F.nullif(F.regexp_extract(html, r.rule, 1), F.lit(""))
        if r.kind == "script":
            return H.script_value(html, r.rule)
        if r.kind == "url":
            return getattr(U, r.rule)(F.col("url"))
        if r.kind == "column":
            return r.rule(html, F.col("url"))
        if r.kind == "const":
            return F.lit(r.rule)
        raise ValueError(f"unknown rule kind {r.kind!r}")


def _typed(rule: Rule, value: Column) -> Column:
    if rule.post:
        value = POSTS[rule.post](value)
    wanted = FIELD_TYPES.get(rule.field)
    return value.try_cast(wanted) if wanted else F.nullif(F.trim(value.cast("string")), F.lit(""))


def _has_text(c: Column) -> Column:
    return F.trim(c.cast("string")) != ""


def extract_fields(pages: DataFrame, rule_sets: dict[str, list[Rule]] | None = None, keep: Sequence[str] = ("page_id",),
                   compat: bool = False, observation: Observation | str | None = None) -> DataFrame:
    """`pages`: url, html, rule_set and the `keep` columns, optionally url_rank and fetched_at.

    One record for each page: keep, page_url, uniq_id, the fields, and `errors`.
    A rule set may have a field others lack; such fields are NULL for the others.

    With an `observation` (a name for streams), `errors` also tells of fields that stayed empty for a reason: `field: cast`, a candidate had text that is no value
    of the field's type, and `field: json`, a candidate's JSON is on the page and does not parse. The same pass counts these, Python errors and
    empty fields by rule set and field; see `observed` and `ObservedFields`.
    """
    rule_sets = rule_sets or RULE_SETS
    everything = [r for rules in rule_sets.values() for r in rules]
    dom_plan = {name: [r for r in rules if r.kind in DOM_KINDS] for name, rules in rule_sets.items()}
    sources = _Sources(everything)
    df = pages
    if any(dom_plan.values()):
        small_batches(df.sparkSession)
        df = df.withColumn("__dom", _dom_function(dom_plan)(F.col("html"), F.col("rule_set")))
    else:
        df = df.withColumn("__dom", F.struct(
            F.array().cast("array<string>").alias("values"), F.array().cast("array<string>").alias("errors")
        ))
    for columns in (sources.columns, sources.second, sources.broken() if observation is not None else {}):
        df = df.withColumns(columns) if columns else df

    fields = list(dict.fromkeys(r.field for r in everything))
    base, later = {}, {"field": {}, "discount": {}}
    failures: dict[tuple[str, str], Column] = {}  # (field, reason) to whether a candidate failed so
    for field in fields:
        chains = []
        for name, rules in rule_sets.items():
            chain = []
            for r in rules:
                if r.field != field:
                    continue
                if r.kind in later:
                    later[r.kind].setdefault(field, []).append((name, r.rule))
                    continue
                raw = F.get(F.col("__dom.values"), F.lit(dom_plan[name].index(r))) if r.kind in DOM_KINDS else sources.value(r)
                chain.append(_typed(r, raw))
                reasons = {"cast": _has_text(raw) & chain[-1].isNull()} if field in FIELD_TYPES else {}
                if sources.name(r):
                    reasons["json"] = F.col(f"`__bad{sources.name(r)}`")
                for reason, failed in reasons.items() if observation is not None else ():
                    failed = (F.col("rule_set") == name) & failed
                    failures[field, reason] = failures[field, reason] | failed if (field, reason) in failures else failed
            if chain:
                chains.append((name, F.coalesce(*chain)))
        value = F.lit(None).cast(FIELD_TYPES.get(field, "string"))
        for name, expr in chains:
            value = F.when(F.col("rule_set") == name, expr).otherwise(value)
        base[field] = value
    rank = F.col("url_rank") if "url_rank" in pages.columns else None
    stamp = {"crawl_timestamp": K.crawl_timestamp(F.col("fetched_at"))} if "fetched_at" in pages.columns else {}
    identity = {"page_url": F.col("url"), "uniq_id": U.uniq_id(F.col("url"), rank, compat), **stamp}
    out = df.select(
        *keep, "rule_set", *[c.alias(n) for n, c in {**identity, **base}.items() if n not in keep],
        F.col("__dom.errors").alias("errors"), *[c.alias(f"__{reason}_{field}") for (field, reason), c in failures.items()],
    )
    # fields that fall back on, or are computed from, other fields
    fallbacks = {}
    for field, cases in later["field"].items():
        value = F.col(field)
        for name, other in cases:
            source = other() if callable(other) else F.col(other)
            value = F.when((F.col("rule_set") == name) & value.isNull(), source).otherwise(value)
        fallbacks[field] = value
    out = out.withColumns(fallbacks) if fallbacks else out
    computed = {}
    for field, cases in later["discount"].items():
        value = F.col(field)
        for name, default in cases:
            last = default() if callable(default) else F.lit(default).cast("int")
            pct = F.coalesce(K.discount_pct(F.col("list_price"), F.col("selling_price")), last)
            value = F.when((F.col("rule_set") == name) & value.isNull(), pct).otherwise(value)
        computed[field] = value
    out = out.withColumns(computed) if computed else out
    if observation is None:
        return out
    told = [F.when(F.col(f"__{reason}_{field}") & F.col(field).isNull(), F.lit(f"{field}: {reason}")) for field, reason in failures]
    out = out.withColumn("errors", F.concat("errors", F.array_compact(F.array(*told)))) if told else out
    out = out.drop(*[f"__{reason}_{field}" for field, reason in failures])
    return out.observe(observation, *_counts(rule_sets, failures))


def _tells_of(field: str) -> Callable[[Column], Column]:
    return lambda error: F.startswith(error, F.lit(f"{field}: "))


def _counts(rule_sets: dict[str, list[Rule]], failures: Iterable[tuple[str, str]]) -> list[Column]:
    """One count for each rule set, field and kind of failure: a number of columns that follows the rules, not the pages."""
    out = [F.count("*").alias("||records")]
    for name, rules in rule_sets.items():
        own = F.col("rule_set") == name
        for field in dict.fromkeys(r.field for r in rules):
            missing = F.col(field).isNull()
            told = F.filter("errors", _tells_of(field))
            kinds = {"empty": missing & (F.size(told) == 0)}
            kinds |= {reason: F.array_contains("errors", f"{field}: {reason}") for f, reason in failures if f == field}
            if any(r.field == field and r.kind == "python" for r in rules):
                kinds["python"] = F.size(F.array_except(told, F.array(F.lit(f"{field}: cast"), F.lit(f"{field}: json")))) > 0
            out += [F.count_if(own & F.coalesce(c, F.lit(False))).alias(f"{name}|{field}|{kind}") for kind, c in kinds.items()]
    return out


def _accounts(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    rows = [(*key.split("|"), n) for key, n in counts.items() if n and not key.startswith("||")]
    return spark.createDataFrame(rows, "rule_set string, field string, kind string, n long")


def observed(spark: SparkSession, observation: Observation) -> DataFrame:
    """rule_set, field, kind (empty, cast, json, python) and n, once an action has run over the records; waits for it."""
    return _accounts(spark, observation.get)


class ObservedFields(StreamingQueryListener):
    """The same for streams: add it to the session, and give `extract_fields` the same name. A replayed batch replaces its own counts."""

    def __init__(self, name: str):
        self.name, self.batches = name, {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is not None and (event.progress.numInputRows or event.progress.batchId not in self.batches):
            self.batches[event.progress.batchId] = row.asDict()

    def onQueryTerminated(self, event) -> None:
        pass

    def accounts(self, spark: SparkSession) -> DataFrame:
        total: Counter = Counter()
        for counts in self.batches.values():
            total.update(counts)
        return _accounts(spark, total)


def field_errors(records: DataFrame) -> DataFrame:
    """Failures by rule set and field."""
    return (
        records.select("rule_set", F.explode("errors").alias("error"))
        .groupBy("rule_set", "error").agg(F.count("*").alias("n"))
    )


def split_sections(pages: DataFrame, tag: str = "p", keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """One page to several sub-documents; the rules then run on each of them."""
    return pages.select(*keep, F.posexplode(H.sections(F.col("html"), tag)).alias("section", "html"))


@F.udtf(returnType="section int, html string")
class SelectSections:
    """Table function form: sub-documents are the elements a path selects."""

    def eval(self, html: str, path: str):
        for number, text in enumerate(Page(html or "").select(path)):
            yield number, text


def split_by_path(pages: DataFrame, path: str, keep: Sequence[str] = ("page_id",)) -> DataFrame:
    source = pages.select(*keep, F.col("html").alias("__html"))
    return source.lateralJoin(SelectSections(F.col("__html").outer(), F.lit(path))).select(
        *keep, "section", F.col("html").alias("text")
    )
