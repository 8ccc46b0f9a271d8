"""Record shapes of the data model as Spark DDL."""

RUN = (
    "project string, site string, schedule_id string, stage string, started_at string, updated_at string, "
    "completed_at string, status string, worker_id string, hostname string, progress map<string,bigint>"
)
RUN_STATUS = f"current_runs map<string, struct<{RUN.replace(' string', ':string').replace(' map', ':map')}>>, " \
             f"last_runs array<struct<{RUN.replace(' string', ':string').replace(' map', ':map')}>>, " \
             f"current_run struct<{RUN.replace(' string', ':string').replace(' map', ':map')}>"
FETCH_METADATA = "url string, output_file string"
FETCH_LOG = (
    "ts timestamp, event_id bigint, endpoint string, domain string, ok boolean, blocked boolean, status_code int, "
    "strategy int, latency_ms double"
)
PAGES = (
    "url string, url_key string, project string, site string, schedule_id string, status_code int, html string, "
    "strategy string, elapsed_s double, fetched_at timestamp"
)
COMMERCE_FIELDS = [
    "crawl_timestamp", "uniq_id", "page_url", "product_name", "list_price", "selling_price", "discount_percentage",
    "color", "size", "description", "sku",
]
MEDIA_FIELDS = [
    "crawl_timestamp", "uniq_id", "page_url", "article_title", "sub_title", "author_name", "post_date",
    "article_content", "image_url",
]
SITE_CONFIG = (
    "project string, site string, seed_url array<string>, depths array<struct<level:int,method:string>>, "
    "request_params map<string,string>"
)
FIELD_CONFIG = "project string, site string, domain string, field string, ord int, rule_kind string, rule string, post string"
DEAD_LETTER = (
    "stage string, url string, domain string, site string, project string, failed_at timestamp, error string, "
    "retry_count int, raw string"
)
