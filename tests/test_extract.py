from pyspark.sql import functions as F

from staylake.operators import extract


def _col(spark, expr, rows, schema="v string"):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_zone_from_address(spark):
    rows = [
        ("Dar  Cercle de Ait  Marrakech",),         # prefix word
        ("Dar  Cercle dOurika  x",),                 # "d" form
        ("Dar  Prefecture de Tanger  x",),
        ("Dar  Province dAl Haouz  x",),
        ("Dar  Arrondissement de Gueliz  x",),
        ("Dar  Caidat de Tameslouht  x",),           # "cadat" matches as a prefix of the part only
        ("Dar  cadat de Tameslouht  x",),
        ("Dar  Pachalik de Tahannaout  x",),
        ("Dar  Commune dAgafay  x",),
        ("Riad  Medina  Marrakesh-Safi  Morocco",),  # fallback: part before region word
        ("Marrakesh  Medina  Morocco",),             # region word only at index 0 -> none
        ("Riad   Gueliz  Prefecture Marrakech",),    # three spaces
        ("\tRiad  \tSidi  Province X",),             # tab padding
        (None,), ("",), ("   ",),
    ]
    out = _col(spark, extract.zone_from_address("v"), rows)
    assert out == ["Cercle de Ait", "Cercle dOurika", "Prefecture de Tanger", "Province dAl Haouz",
                   "Arrondissement de Gueliz", None, "cadat de Tameslouht", "Pachalik de Tahannaout",
                   "Commune dAgafay", "Medina", None, "Gueliz", "Sidi", None, None, None]


def test_price_tiers(spark):
    rows = [
        (["MAD 1,200", " 950 "], ["9,999"], "€ 12"),       # tier 1 wins
        ([], ["MAD 1,250", "x"], "€ 12"),                  # tier 2 (commas removed)
        (["no digits"], None, "from €45 to $ 1200 or £7"), # tier 3, two to five digits
        ([], [], "nothing"),                               # none -> NULL
    ]
    df = spark.createDataFrame(rows, "cells array<string>, generic array<string>, page string")
    prices = extract.price_candidates(F.col("cells"), F.col("generic"), F.col("page"))
    out = [tuple(r) for r in df.select(F.array_min(prices), F.array_max(prices)).collect()]
    assert out == [(950, 1200), (1250, 1250), (45, 1200), (None, None)]


def test_category_from_breadcrumb(spark):
    rows = [("Hotels (Marrakech) (Riad) (12)",), ("x (Guest House)",), ("y (Condo Hotel) (3)",),
            (" Plain text ",), ("a (Villa)",)]
    assert _col(spark, extract.category_from_breadcrumb("v"), rows) == \
        ["Riad", "Riad", "Apartment-Hotel", "Plain text", "Villa"]


def test_coordinates(spark):
    rows = [
        ('{"latitude":31.6,"longitude":-7.9}',),
        ('{"lat":35.7,"lng":-5.8}',),
        ('"latitude":1.2.3,"longitude":4 "lat":2.5,"lng":3.5',),   # malformed first pattern falls back
        ('"latitude":31.6,"longitude":-7.9 "lat":1,"lng":2',),     # first pattern wins
        ('"lat":0,"lng":-5.8',),                                    # zero -> unusable
        ("none",),
    ]
    df = spark.createDataFrame(rows, "v string")
    c = extract.usable_coordinates(extract.coordinates("v"))
    out = [tuple(r) for r in df.select(c["latitude"], c["longitude"]).collect()]
    assert out == [(31.6, -7.9), (35.7, -5.8), (2.5, 3.5), (31.6, -7.9), (None, None), (None, None)]


def test_wifi_speed(spark):
    assert _col(spark, extract.wifi_speed("v"), [("WiFi • 50 Mbps",), (None,)]) == ["50 Mbps", "Not specified"]


def test_geocode_fields(spark):
    rows = [
        ('{"display_name": "Riad, Derb 5, مراكش", "address": {"suburb": "Gueliz", "city": " Marrakech "}}',),
        ('{"display_name": "X", "address": {"neighbourhood": "", "quarter": "حي", "district": "D2",'
         ' "town": "Town", "village": "V"}}',),
        ('{"address": {"neighbourhood": "###"}}',),
        ('{"display_name": "Y"}',),
        ("not json",),
        ("[1, 2]",),
    ]
    df = spark.createDataFrame(rows, "v string")
    g = extract.geocode_fields("v")
    out = [tuple(r) for r in df.select(g["address"], g["zone"], g["city"]).collect()]
    assert out == [("Riad  Derb 5 ", "Gueliz", "Marrakech"),  # strip runs before commas become spaces
                   ("X", "D2", "Town"),
                   ("", "", None),
                   ("Y", None, None),
                   (None, None, None),
                   (None, None, None)]


def test_links_first_canonical_and_cap(spark):
    pages = spark.createDataFrame([
        (1, '<a href="/hotel/a.html?x=1">a</a><a href="/hotel/b.html">b</a><a href="/other">o</a>'),
        (2, '<a href="/hotel/a.html?x=2">a</a><a href="">e</a><a href="/hotel/c.html">c</a>'),
    ], "page_id long, html string")
    links = extract.page_links(pages)
    out = [tuple(r) for r in extract.canonical_links(links, ["page_id", "pos"], "/hotel/", 2)
           .select("page_id", "pos", "href").collect()]
    assert out == [(1, 0, "/hotel/a.html?x=1"), (1, 1, "/hotel/b.html")]
    full = extract.canonical_links(links, ["page_id", "pos"], "/hotel/", 10).count()
    assert full == 3


def test_link_pattern_fallback_and_status(spark):
    pages = spark.createDataFrame([
        (1, '<a data-testid="title-link" href="/t1">x</a><a href="/g">'),
        (2, '<a href="/g2">'),
        (3, "Please verify you are human"),
        (4, "No results for your search"),
        (5, "hello"),
    ], "page_id long, html string")
    pats = ['data-testid="title-link" href="([^"]*)"', extract.HREF_PATTERN]
    links = extract.extract_links("html", pats)
    out = [tuple(r) for r in pages.select(links, extract.page_status("html", F.size(links) > 0)).collect()]
    assert out == [(["/t1"], "links"), (["/g2"], "links"), ([], "suspect"), ([], "empty"), ([], "unknown")]


def test_merge_lookup_overwrites_when_matched(spark):
    df = spark.createDataFrame([(1, 31.5, -8.0, "old", "z", "c"), (2, 0.0, -8.0, "old", "z", "c"),
                                (3, 10.0, 10.0, "old", "z", "c")],
                               "id int, latitude double, longitude double, address string, zone string, city string")
    lookup = spark.createDataFrame([(31.5, -8.0, "new", None, "C"), (0.0, -8.0, "n0", "z0", "c0")],
                                   "latitude double, longitude double, address string, zone string, city string")
    from staylake.operators.quality import coordinates_present
    out = extract.merge_lookup(df, lookup, ["latitude", "longitude"], ["address", "zone", "city"],
                               when=coordinates_present())
    rows = sorted(tuple(r) for r in out.select("id", "address", "zone", "city").collect())
    assert rows == [(1, "new", None, "C"), (2, "old", "z", "c"), (3, "old", "z", "c")]


def test_search_url(spark):
    import datetime as dt
    df = spark.createDataFrame([("Marrakech",)], "d string")
    url = df.select(extract.search_url("d", "https://s.example.com/r?", dt.date(2025, 9, 4))).first()[0]
    assert url == ("https://s.example.com/r?ss=Marrakech&checkin=2025-09-04&checkout=2025-09-05"
                   "&group_adults=1&no_rooms=1&group_children=0")


def test_each_source_is_searched_once_in_the_plan(spark):
    df = spark.createDataFrame([("x", "y")], "page string, v string")

    def plan(*cols):
        return df.select(*[c.alias("c") for c in cols])._jdf.queryExecution().optimizedPlan().toString().lower()

    assert plan(extract.geocode_fields("v").alias("g")).count("from_json") == 1
    found = plan(extract.price_candidates(extract.find_all("page", "<a>(.*?)</a>", 1),
                                          extract.find_all("page", "<b>(.*?)</b>", 1), F.col("page")))
    assert found.count("regexp_extract_all") == 3
    assert plan(extract.category_from_breadcrumb("v")).count("regexp_extract_all") == 1
    assert plan(extract.nth_numbers("v", "([0-9])", {"a": 1, "b": 2})).count("regexp_extract_all") == 1
    located = plan(extract.coordinates("page"))
    assert located.count("regexp_substr") + located.count("regexpinstr") <= len(extract.COORDINATE_PATTERNS)


def test_status_reads_visible_text_only(spark):
    pages = ["<script src='/verify.js'>captcha</script><p>hello</p>", "<p>Please <b>verify</b> yourself</p>",
             "<!-- no results --><title>x</title>", "<div class='captcha'>No results</div>", None,
             "price a < b, sorry no results", "if 3 <4 then captcha here", "<!doctype no results <p>x"]
    assert _col(spark, extract.page_status("v", F.lit(False)), [(p,) for p in pages]) == \
        ["unknown", "suspect", "unknown", "empty", "unknown", "empty", "suspect", "unknown"]


def test_lookup_that_repeats_a_key_multiplies_nothing(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k int, city string")
    lookup = spark.createDataFrame([(1, "z"), (1, "m"), (1, None), (3, "q")], "k int, city string")
    got = extract.merge_lookup(rows, lookup, ["k"], ["city"]).orderBy("k").collect()
    assert [(r["k"], r["city"]) for r in got] == [(1, "m"), (2, "b")]
