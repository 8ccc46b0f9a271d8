"""The labelled addresses of the URL filter: hosts written from general knowledge, a fourth of those listed kept out of training.

Real advertising, gambling and adult hosts, invented ones after the wording of such sites, and ordinary hosts of many kinds and languages,
among them some that hold the words of unwanted ones (essex, alphabet, adult education). None is taken from the given pages.
For training only, pairs of common words make further hosts, with the same endings for both labels, so that an ending or a hyphen says little.
"""

from __future__ import annotations

from zlib import crc32

UNWANTED = {
    "gambling": """
        bet365.com pokerstars.com betfair.com williamhill.com ladbrokes.com unibet.com bwin.com betway.com 888casino.com partypoker.com draftkings.com
        fanduel.com stake.com 1xbet.com paddypower.com leovegas.com betsson.com casumo.com bovada.lv pinnacle.com mrgreen.com jackpotcity.com
        royal-vegas-casino.com luckyslots.net spin-palace.org megajackpots.info goldenreels.club onlineroulette.biz blackjack-tips.net vip-casino-bonus.com
        slots4cash.net pokerrooms.info freespins-daily.com bingo-jackpot.org sportsbetting-picks.com livebets24.net bet-on-football.info casino-en-ligne-bonus.fr
        online-casino-echtgeld.de apuestas-deportivas-hoy.es casinosinlicencia.net slotmachines-free.org roulette-system.biz betting-odds-tips.com
        crypto-casino-slots.io winbig-lottery.net lotto-jackpot-winner.com poker-chips-free.net scratchcards-online.org baccarat-vip.club
        casinobonus-nodeposit.com bestbookmakers-bonus.net bet-exchange-pro.com slotsplay777.com lucky7casino.net wettbonus-ohne-einzahlung.de
    """,
    "adult": """
        pornhub.com xvideos.com xnxx.com xhamster.com redtube.com youporn.com chaturbate.com stripchat.com brazzers.com spankbang.com onlyfans.com
        livejasmin.com bongacams.com adultfriendfinder.com ashleymadison.com playboy.com cam4.com myfreecams.com tube8.com eporner.com beeg.com
        hot-girls-cams.net freeporn-tube.org sexy-singles-near.com milf-videos.xxx nude-webcams.tv adult-videos-hd.net sexchat-live.org xxx-movies.biz
        erotik-kontakte.de rencontres-coquines.fr sexo-gratis.es escort-girls-vip.com hotwives-dating.net amateur-porn-clips.info hentai-gallery.club
        naked-celebs-pics.com adult-dating-local.org sex-toys-cheap.biz fetish-cams.tv teen-xxx-tube.net porno-kostenlos.de camgirls-live.net
        strippers-online.com adultgames-free.net sexstories-hot.org lesbian-porn-hd.com adultsonly-chat.com erotic-massage-vip.net bigtits-videos.net
        nsfw-pics.xyz adult-webcam-shows.com xxxpass.net swingers-club-dating.com adult-movie-rental.net
    """,
    "pharmacy": """
        buy-viagra-online.net cialis-generic.biz canadian-pharmacy-rx.com no-prescription-meds.org cheapmeds24.net tramadol-overnight.info xanax-for-sale.com
        discount-drugstore-rx.biz pills-without-prescription.net levitra-cheap.org kamagra-shop.eu potenzmittel-rezeptfrei.de acheter-viagra.fr
        comprar-cialis-barato.es diet-pills-fast.com slimming-tablets.net weightloss-miracle.info keto-gummies-official.com fatburner-pills.biz
        testosterone-boost-pills.com male-enhancement-pro.net penis-enlarge.org hgh-steroids-shop.com anabolic-store.biz cbd-gummies-discount.net
        hairloss-miracle-cure.com modafinil-buy.net generic-meds-mart.com rxpills-express.org steroids-online.biz onlinepharmacy-cheap.ru
    """,
    "advertising": """
        doubleclick.net googlesyndication.com adnxs.com taboola.com outbrain.com criteo.com rubiconproject.com pubmatic.com openx.net adroll.com
        scorecardresearch.com quantserve.com adform.net smartadserver.com popads.net propellerads.com adcash.com exoclick.com trafficjunky.net
        zedo.com advertising.com adsrvr.org casalemedia.com mediavine.com mgid.com revcontent.com clickbank.net cj-affiliates.net admob.com moatads.com
        adserver-one.net banners-exchange.org clicktracker.info popunder-traffic.com ad-pixel.net trk-redirect.com adclicks-network.biz adimg-cdn.net
        tracking-pixel.io affiliate-clicks.net sponsored-ads.info cpm-banner.com adsdelivery.net ads-serving.net retarget-ads.com paid-clicks.org
        trackingcodes.net impression-tracker.com adtech-sync.net adfarm-media.com pushads-network.com adnetwork-exchange.net
    """,
    "link spam": """
        buy-backlinks-cheap.com seo-links-pro.net linkexchange-free.biz web-directory-submit.info pagerank-boost.org guestpost-links.com article-spinner.net
        comment-spam-bot.com spamlinks-directory.info bulk-email-blaster.com buy-followers-fast.com instalikes-cheap.net youtube-views-shop.com
        get-free-traffic.biz autosurf-traffic.net doorway-pages.info scraped-content.xyz keyword-stuffing.top expired-domains-links.net linkfarms.info
        linkwheel-service.org mass-mailer-pro.com spambot-tools.net pbn-backlinks.com cheap-web-traffic.ru contentfarm-articles.biz spam-email-lists.com
        backlink-farm.top seo-spam-service.net free-directory-links.xyz
    """,
    "money and scams": """
        payday-loans-now.com quick-cash-advance.net bad-credit-loans.biz instant-loan-approval.org get-rich-quick.info make-money-fast.net work-from-home-cash.com
        forex-robot-profits.com binary-options-win.net bitcoin-doubler.org crypto-giveaway.live free-iphone-winner.com claim-your-prize.net
        free-giftcards-generator.com survey-rewards-cash.info you-have-won.xyz lottery-winner-claim.com nigerian-inheritance.biz tech-support-alert.info
        your-pc-is-infected.com account-verify-login.xyz secure-paypal-update.info bank-login-confirm.top kredit-ohne-schufa-sofort.de
        credit-rapide-sans-justificatif.fr dinero-rapido-facil.es passive-income-secret.com hyip-invest.biz mlm-millionaire.net debt-relief-fast.com
        cheap-car-insurance-quotes.biz timeshare-exit-cash.com psychic-reading-free.net fake-diploma-buy.com free-robux-generator.net
    """,
    "copies": """
        thepiratebay.org 1337x.to rarbg.to fmovies.to putlocker.vip 123movies.la limetorrents.lol kickass-torrents.cr warez-download.net cracked-software.org
        keygen-serials.com nulled-scripts.net free-movies-stream.xyz watch-movies-free-hd.net mp3-download-free.biz torrent-games-crack.com serial-keys.info
        replica-rolex-shop.com fake-handbags.biz louis-vuitton-outlet-cheap.net cheap-jerseys-china.com ray-ban-sale-90off.net ugg-boots-outlet.org
        nike-shoes-wholesale.ru designer-replicas.cc cheap-oakley-outlet.com discount-gucci-bags.net michael-kors-clearance.biz
    """,
}

ORDINARY = {
    "reference and learning": """
        wikipedia.org wiktionary.org britannica.com gutenberg.org archive.org khanacademy.org coursera.org mit.edu stanford.edu harvard.edu ox.ac.uk cam.ac.uk
        essex.ac.uk sussex.ac.uk middlesex.edu uni-heidelberg.de tu-muenchen.de sorbonne-universite.fr ucm.es ub.edu ethz.ch openstax.org jstor.org arxiv.org
        dictionary.com merriam-webster.com duden.de larousse.fr rae.es leo.org worldcat.org loc.gov bl.uk bnf.fr dnb.de adult-education.org.uk
        adultlearning.net literacytrust.org.uk montessori-school.org highschool-physics.net mathworld.wolfram.com alphabet-songs.org openculture.com
        citizendium.org plato.stanford.edu etymonline.com geschichte-online.de biologie-lexikon.de cours-de-chimie.fr historia-antigua.es
    """,
    "news": """
        bbc.co.uk nytimes.com theguardian.com reuters.com apnews.com washingtonpost.com economist.com ft.com bloomberg.com cnn.com npr.org aljazeera.com
        spiegel.de zeit.de faz.net sueddeutsche.de tagesschau.de lemonde.fr lefigaro.fr liberation.fr ouest-france.fr elpais.com elmundo.es abc.es
        lavanguardia.com corriere.it nzz.ch derstandard.at theatlantic.com time.com newyorker.com politico.eu chicagotribune.com seattletimes.com
        dailyherald.com thenorthernecho.co.uk irishtimes.com heraldscotland.com smh.com.au thehindu.com japantimes.co.jp lokalnachrichten.de
    """,
    "science and health": """
        nature.com science.org nasa.gov noaa.gov cern.ch esa.int who.int nih.gov cdc.gov mayoclinic.org nhs.uk cancer.org webmd.com thelancet.com plos.org
        pharmacy.school.edu pharmacology-journal.org medicine-net.org drugs.com apotheken-umschau.de sante.fr saludmadrid.org therapists-association.org
        diabetes.org.uk heart.org nutrition.org physiotherapy-clinic.net dentistry-today.com nursing-times.net geology.com astronomy-society.org
        weather.gov wetter.de meteofrance.com aemet.es earthquake.usgs.gov botanicgarden.org birdlife.org oceanexplorer.org sexual-health-clinic.nhs.uk
    """,
    "government and society": """
        gov.uk usa.gov europa.eu un.org parliament.uk bundestag.de service-public.fr boe.es nyc.gov london.gov.uk paris.fr berlin.de madrid.es
        redcross.org amnesty.org unicef.org greenpeace.org oxfam.org caritas.de emmaus-france.org rotary.org scouts.org.uk salvationarmy.org
        stmarys-church.org synagogue-council.org mosque-foundation.org courts.state.us library-of-alexandria.org taxpayers-alliance.org
        fire-department.org volunteers-network.org housing-association.org.uk consumer.org citizensadvice.org.uk foodbank.org farmers-union.org
    """,
    "technology": """
        python.org kernel.org github.com gitlab.com stackoverflow.com mozilla.org apache.org debian.org ubuntu.com postgresql.org docker.com kubernetes.io
        rust-lang.org golang.org nodejs.org readthedocs.io w3.org ietf.org microsoft.com apple.com ibm.com intel.com hackaday.com arstechnica.com wired.com
        heise.de golem.de numerama.com xataka.com linux-magazin.de raspberrypi.org arduino.cc sqlite.org jquery.com wordpress.org drupal.org
        tracker.debian.org bugs.launchpad.net downloads.openwrt.org adapter-guide.net addons.mozilla.org package-tracking.dhl.de betanews.com
        alphabetagames.dev threejs.org tensorflow.org freesoftware.org freebsd.org openstreetmap.org serialport.io
    """,
    "culture and leisure": """
        louvre.fr metmuseum.org tate.org.uk museodelprado.es rijksmuseum.nl imdb.com rottentomatoes.com discogs.com musicbrainz.org allmusic.com
        goodreads.com poetryfoundation.org operabase.com theatre-royal.org orchestra-berlin.de casino-theater-winterthur.ch chess.com boardgamegeek.com
        fifa.com uefa.com olympics.com nba.com cricinfo.com kicker.de lequipe.fr marca.com trackandfield.org cyclingnews.com runnersworld.com
        bridge-club.org gardeningknowhow.com knitting-patterns.net photography-blog.net philatelie.fr modelltrains.de birdwatching-club.org
        loadstar-sailing.org pokemon.com comics.org filmfest-cannes.fr jazzfestival-montreux.ch readingclub.org shakespeare.org.uk
    """,
    "food, travel and homes": """
        allrecipes.com epicurious.com chefkoch.de marmiton.org recetasgratis.net seriouseats.com tripadvisor.com lonelyplanet.com booking.com
        airbnb.com nationalrail.co.uk bahn.de sncf.com renfe.com lufthansa.com ryanair.com hotel-adler.de auberge-du-lac.fr casa-rural-pirineos.es
        visitnorway.com alpenverein.de nationalparks.org camping-france.fr betterhomes.com ikea.com farmersmarket.org treadmill-farm.co.uk organic-farm.org
        restaurant-guide.com bakery-lane.com vineyard-tours.com wandern-im-harz.de rentals-by-owner.com architecture-digest.com interior-design.net
        cheaptickets.com freecycle.org garden-furniture.co.uk thebreadbakers.net mother-and-child.org
    """,
    "shops, firms and people": """
        amazon.com ebay.com etsy.com target.com walmart.com zalando.de fnac.com elcorteingles.es decathlon.fr bookshop.org waterstones.com thalia.de
        siemens.com bosch.de renault.fr toyota.com nestle.com unilever.com creditunion.org deutsche-bank.de hsbc.co.uk bnpparibas.com allianz.de visa.com
        law-office-miller.com smithandsons-plumbing.co.uk zahnarzt-schmidt.de cabinet-dupont.fr abogados-garcia.es jane-doe-writes.net annas-blog.org
        travels-with-tom.net physics-teacher.blog our-family-history.org hardware-store.com pet-supplies.co.uk discount-bookstore.com
        musicshop-berlin.de adsum-consulting.com loan-library.org trackless-railway.co.uk printing-house.net clothing-bank.org toyshop.co.uk
        linkedin.com reddit.com medium.com blogger.com livejournal.com tumblr.com flickr.com vimeo.com spotify.com soundcloud.com pinterest.com
    """,
}

# Words of unwanted hosts, words that go with either kind, and ordinary words.
BAD_WORDS = """
    casino casinos poker slots jackpot roulette blackjack betting bets bet bookmaker bookies gambling gamble lottery lotto bingo spins baccarat wager odds wetten
    apuestas porn porno sex sexy xxx nude naked adult adults erotic erotik escort escorts cams webcam camgirls milf hentai fetish hardcore amateur strip swinger
    hookup dating singles viagra cialis levitra pills pill meds rx tramadol xanax drugstore steroids slimming weightloss diet potency ads ad adserver advert
    adverts banner banners popup popunder tracker tracking track clicks click pixel affiliate affiliates sponsored cpm retarget adtech backlinks linkfarm links
    seo spam spammer spambot farm traffic followers likes bulk blaster doorway payday loan loans cash credit lender debt earn rich millionaire forex crypto bitcoin
    doubler hyip profit profits binary prize prizes winner giveaway claim reward giftcard free win lucky replica replicas rolex fake outlet cheap discount wholesale
    warez crack cracked keygen serials nulled torrent torrents pirate streams unlocked hack hacks cheats phishing verify virus miracle enlarge enhancement
    viagra-online online-casino free-porn sex-chat buy-cheap hot-girls fast-cash live-cams no-deposit sports-bets
""".split()
FILLERS = "online best top my the pro net hub zone world 24 365 shop store club now direct live daily web site center info plus one city".split()
GOOD_WORDS = """
    garden school music history weather river mountain forest kitchen recipe bread coffee tea wine cheese orchard meadow village town street house home family
    children mother father brother sister teacher student college library museum gallery theatre opera orchestra choir violin piano guitar painting sculpture
    photography camera film cinema poetry novel author writer reader book journal magazine paper letter pencil science physics chemistry biology geology
    astronomy planet star moon sun ocean island harbour lighthouse ship sailing fishing hiking climbing cycling running swimming football tennis cricket rugby
    chess puzzle knitting sewing pottery carpentry woodwork metal stone bridge tower castle cathedral church temple monastery parish council mayor citizen
    parliament law court justice police fire ambulance hospital clinic doctor nurse dentist therapy health medicine vaccine nutrition engineer software developer
    open source data network computer robot machine engine motor bicycle train railway tram bus airport travel hotel hostel camping beach winter summer spring
    autumn north south east west green blue white black silver golden red old new young little great thing nothing other another thought through weather whether
    there where nation station action motion question education tradition translation foundation institute association union federation society community
    neighbour friend volunteer charity market farmer dairy cattle sheep horse dog cat bird eagle owl fox bear wolf flower rose tulip oak maple pine cedar apple
    pear cherry lemon orange tomato potato pepper salt sugar honey butter egg fish salmon chicken soup salad dinner lunch breakfast restaurant bakery butcher
    grocer tailor shoe coat dress wool cotton linen leather glass paper print press news herald gazette tribune chronicle observer report review letters forum
    wiki archive docs guide manual course lesson tutorial lecture seminar exam degree research thesis paper study theory method number algebra geometry
    statistics economics finance bank insurance pension tax budget energy solar wind water electric power climate nature wildlife park zoo aquarium trail path
    road map atlas compass clock calendar event concert festival ballet dance folk jazz rock classic radio channel television podcast video game toys craft
    universitaet schule garten wetter nachrichten buch musik verein gemeinde reise kueche bibliothek kirche werkstatt verlag ecole jardin musique livre voyage
    cuisine mairie theatre histoire nature maison escuela jardin musica libro viaje cocina biblioteca historia ciudad noticias teatro casa
    threads theorem thistle thunder strength breathe weathering northern southern brethren lathe teeth math cloth earth birth health wealth
""".split()
ENDINGS = ("com", "net", "org", "info", "de", "fr", "es", "co.uk", "eu", "io", "biz", "club")

STARTS = ("http://", "https://", "http://www.", "https://www.", "https://m.", "http://blog.")
# Paths that say little, of either label, and some that are more common with one.
PLAIN = ("/", "", "/en/{}", "/de/{}.html", "/fr/{}/", "/es/{}", "/index.html", "/{}", "/page/{}", "/about", "/news/{}", "/view?id={}", "/a/{}#top", "/p/{}.php")
OF_LABEL = {
    1: ("/bonus", "/click?id={}", "/redirect?to={}", "/buy-now", "/join-free", "/order/cheap", "/live-cams", "/claim", "/pixel.gif", "/free-trial", "/signup?aff={}", "/promo/{}"),
    0: ("/wiki/History", "/articles/2021/05/{}", "/contact", "/docs/latest/", "/research/papers", "/opening-hours", "/recipes/{}", "/archive/{}", "/team", "/events/calendar",
        "/products/{}", "/faq"),
}


def kept_out(host: str) -> bool:
    """A fourth of the hosts, by a hash of the host."""
    return crc32(host.encode()) % 4 == 0


def made_hosts(label: int) -> list[str]:
    """Pairs of words of one label, or of one and a filler, with and without a hyphen; none that is listed above."""
    own = sorted(set(BAD_WORDS if label else GOOD_WORDS))
    listed = {h for groups in (UNWANTED, ORDINARY) for text in groups.values() for h in text.split()}
    hosts = set()
    for word in own:
        for k in range(12 if label else 7):
            n = crc32(f"{word}/{k}".encode())
            other = (own if k % 2 == 0 else FILLERS)
            pair = [word, other[n // 7 % len(other)]]
            joined = ("-", "")[n // 3 % 2].join(pair if n % 3 else pair[::-1])
            hosts.add(f"{joined}.{ENDINGS[n // 1009 % len(ENDINGS)]}")
    return sorted(hosts - listed)


def rows(out: bool) -> tuple[tuple[str, int], ...]:
    """(url, label) of the hosts kept out of training, or of the others and the made ones.

    A listed host has three addresses, two of them with plain paths; a made one has one with a plain path.
    """
    found = []
    for label, groups in ((1, UNWANTED), (0, ORDINARY)):
        for host in sorted({h for text in groups.values() for h in text.split()}):
            if kept_out(host) == out:
                n = crc32(b"/" + host.encode())
                paths = (PLAIN[n % len(PLAIN)], PLAIN[n // 97 % len(PLAIN)], OF_LABEL[label][n // 1013 % len(OF_LABEL[label])])
                found.extend((STARTS[(n // 31 + k) % len(STARTS)] + host + path.format(n // 7 % 10_000), label) for k, path in enumerate(paths))
        for host in [] if out else made_hosts(label):
            n = crc32(b"/" + host.encode())
            found.append((STARTS[n // 31 % len(STARTS)] + host + PLAIN[n % len(PLAIN)].format(n // 7 % 10_000), label))
    return tuple(found)
