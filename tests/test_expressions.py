"""Inline cases of the column expressions."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cartloom.functions import commerce, forms, html, money, options, seo, text, urls


def one(spark, *cols):
    return tuple(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first())


def signature(stamp, secret):
    import base64
    import hashlib
    import hmac

    digest = hmac.new(secret.encode(), stamp.encode(), hashlib.sha256).digest()
    return base64.urlsafe_b64encode(digest).rstrip(b"=").decode()


def words(*values):
    return F.array(*[F.lit(v) for v in values])


def test_colours_sizes_genders(spark):
    colours = ["Navy Blue", "Gray", "Light Gray", "black", "Black / Gray", "teal o'neil-x"]
    assert one(spark, *[options.normalize_colour(F.lit(c)) for c in colours]) == (
        "Navy", "Grey", "Grey", "Black", "Black / Grey", "Teal O'Neil-X",
    )
    sizes = ["XXL", "3X", "SM", "ML", "l", "36 - 41", "One size"]
    assert one(spark, *[options.normalize_size(F.lit(s)) for s in sizes]) == ("2XL", "3XL", "S/M", "M/L", "L", "36-41", "One size")
    genders = ["Male", "Man", "Female", "women"]
    assert one(spark, *[options.normalize_gender(F.lit(g)) for g in genders]) == ("Men", "Men", "Women", "Women")


def test_size_systems_and_order(spark):
    assert one(
        spark,
        options.size_option_name(words("36-41", "42-46")),
        options.size_option_name(words("S", "M")),
        options.size_option_name(words("S", "36-41")),
        options.size_option_name(F.array().cast("array<string>")),
    ) == ("Sock Size", "Size", None, "Size")
    assert one(spark, options.sort_option_values(F.lit("Size"), words("2XL", "S", "M/L", "XS", "S", "odd")))[0] == ["XS", "S", "M/L", "2XL", "odd"]
    assert one(spark, options.sort_option_values(F.lit("Sock Size"), words("42", "36-41", "9")))[0] == ["9", "36-41", "42"]


def test_product_axes(spark):
    kinds = one(
        spark,
        options.product_type(words("Kneepads"), F.lit("Knee Pad")),
        options.product_type(words("T-Shirts"), F.lit("Tee")),
        options.product_type(words("Shorts", "Jerseys"), F.lit("x")),
        options.product_type(words("none"), F.lit("Beach Shorts")),
        options.product_type(words("none"), F.lit("Zzz")),
    )
    assert [tuple(k) for k in kinds] == [
        ("accessories", "category"), ("tops", "category"), ("jerseys", "category"), ("shorts-pants", "name-inferred"), ("accessories", "fallback"),
    ]
    assert one(
        spark, options.surface(words("Beach Volleyball"), F.lit("x")), options.surface(words("Jerseys"), F.lit("x")), options.surface(words("Hoodies"), F.lit("x")),
        options.clubs(words("Teamwear", "West Club"), F.lit("x")), options.clubs(words("Teamwear"), F.lit("x")), options.genders(words("a"), words("other")),
    ) == ("beach", "indoor", None, ["west-club"], ["teamwear"], ["Unisex"])
    assert tuple(one(spark, options.choice_checked(words("beach", "moon"), ["beach", "indoor"]))[0]) == (["beach"], ["moon"])


def test_text(spark):
    assert one(
        spark, text.clean_text(F.lit("  Tom &amp; Jo ")), text.clean_text(F.lit(None).cast("string")), text.one_line_text(F.lit("a \r\n\n b")),
        text.slugify(F.lit("Crème &amp; Brûlée!")), text.slugify(F.lit("!!")), text.storefront_slug(F.lit("Shorts & Pants")),
        text.stamp_tz(F.lit("2024-01-01T00:00:00")), text.stamp_tz(F.lit("2024-01-01T00:00:00Z")), text.stamp_tz(F.lit("")),
        text.generate_sku(F.lit(6), F.lit(7), "PX"), text.file_stem(F.lit("https://x/a%20B_c.JPG?v=1")),
    ) == ("Tom & Jo", "", "a b", "creme-brulee", "untitled", "shorts-and-pants", "2024-01-01T00:00:00+00:00", "2024-01-01T00:00:00Z", "", "PX-6-7", "abc")


@pytest.mark.parametrize(
    "cell,safe", [("=1+1", "'=1+1"), ("@x", "'@x"), ("-5", "-5"), ("-5.20", "-5.20"), ("-x", "'-x"), ("\tx", "'\tx"), ("ok", "ok"), (None, ""), ("+61 2", "'+61 2")]
)
def test_neutralise(spark, cell, safe):
    assert one(spark, text.neutralise(F.lit(cell).cast("string"))) == (safe,)


def test_money(spark):
    assert one(
        spark, money.money(F.lit("1,234.5")), money.money(F.lit("2.345")), money.money(F.lit("2.345"), half_even=False), money.money(F.lit("NaN")), money.money(F.lit("")),
        money.money_text(F.lit("x")), money.kg_to_grams(F.lit("0.35")), money.kg_to_grams(F.lit("no")), money.js_round2(F.lit(-1.005).cast("decimal(10,3)")),
    ) == (Decimal("1234.50"), Decimal("2.34"), Decimal("2.35"), None, None, "", 350, None, Decimal("-1.00"))


def test_checksum_ignores_column_order_but_not_nulls(spark):
    df = spark.createDataFrame([(1, None, "x")], "b int, a string, c string")
    left, right, fewer = df.select(
        text.record_checksum("a", "b", "c"), text.record_checksum("c", "b", "a"), text.record_checksum("b", "c")
    ).first()
    assert left == right != fewer


def test_urls(spark):
    hosts = ["www.old.invalid", "old.invalid"]
    cases = {
        "https://www.old.invalid//A%20b/?utm_source=1&b=2&a=%41&amp;c": "/a b?a=A&b=2&c=",
        "/x/?add-to-cart=3": None,
        "/x?add-to-cart=3&page=2": "/x?add-to-cart=3&page=2",
        "/x?min_pricey=3": "/x?min_pricey=3",
        "https://else.invalid/x": None,
        "mailto:a@b": None,
        "/pic.JPG": None,
        "/wp-admin/x": None,
        "": None,
        "https://old.invalid": "/",
        "/a+b/": "/a+b",
    }
    assert one(spark, *[urls.normalize_url(F.lit(c), hosts) for c in cases]) == tuple(cases.values())
    assert one(
        spark, urls.original_of(F.lit("https://a/b/c-1024x768.jpg")), urls.original_of(F.lit("https://a/b/c.jpg")), urls.absolutise(F.lit("//a/b"), "o"),
        urls.absolutise(F.lit("/b"), "o"), urls.content_type(F.lit("https://a/b.pdf"), F.lit("")), urls.content_type(F.lit("https://a/b.webp"), F.lit(None).cast("string")),
        urls.canonical_path(F.lit("//a//b///")), urls.lookup_keys(F.lit("/A%20b")), urls.page_view_path(F.lit("shop"), F.lit("?")), urls.page_view_path(F.lit("/shop"), F.lit("a=1")),
        urls.deployment_url("https://s/", F.lit("/")), urls.proxied_image(F.lit("https://s/_next/image?url=%2Fa.jpg&w=3")),
    ) == ("https://a/b/c.jpg", None, "https://a/b", "https://o/b", "FILE", "IMAGE", "/a/b", ["/A%20b", "/a b"], "/shop", "/shop?a=1", "https://s", "/a.jpg")
    base = F.lit("https://s.invalid/a/b?q=1")
    links = ["c", "/d?x=1#f", "https://s.invalid", "https://t.invalid/", "x.css", "/api/1", "#top", "?p=2", "mailto:x"]
    assert one(spark, *[urls.same_host_link(F.lit(h), base) for h in links]) == (
        "https://s.invalid/a/c", "https://s.invalid/d?x=1", "https://s.invalid/", None, None, None, "https://s.invalid/a/b?q=1", "https://s.invalid/a/b?p=2", None,
    )


def test_html(spark):
    dirty = '<!-- c --><p class="x" onclick="y">a<script>b<\\/script></script><style>s</style><a href="javascript:1" title="t&quot;">k</a><img src="//e" alt="q"><br/><custom>z</custom></p>\n \n<iframe src=x></iframe>'
    clean, again, plain, cut = one(
        spark, html.sanitize_html(F.lit(dirty)), html.sanitize_html(html.sanitize_html(F.lit("<p>a<br>b</p>"))),
        html.html_to_text(F.lit("<p>a&nbsp;&amp; b</p><script>x</script>")), html.html_to_text(F.lit("word " * 20), 12),
    )
    assert clean == '<p>a<a title="t&amp;quot;">k</a><img alt="q" /><br />z</p>'
    assert again == "<p>a<br />b</p>" and plain == "a & b" and cut == "word word w…"
    forms = "<td colspan=2 rowspan = '3' Scope=a>x</td><a HREF=' http://a?b=1&c=2 ' x>y</a> 1 < 2 <img src='a\"b' alt='x<y>' />"
    kept, none, long = one(
        spark, html.sanitize_html(F.lit(forms)), html.sanitize_html(F.lit(None).cast("string")), F.length(html.sanitize_html(F.repeat(F.lit("x <b>"), 50000)))
    )
    assert kept == '<td colspan="2" rowspan="3">x</td><a href="http://a?b=1&amp;c=2">y</a> 1 < 2 <img alt="x&lt;y&gt;" />'
    assert none == "" and long == 250000


def test_commerce(spark):
    cart = spark.createDataFrame(
        [("100", "0", "AUD", ["10.5", "junk"]), ("100", "80", "AUD", None), ("5", "0", None, ["9"])], "subtotal string, total string, currency string, allocations array<string>"
    ).select(commerce.cart_totals(F.struct("*"), "NZD").alias("t"))
    rows = [tuple(r.t) for r in cart.collect()]
    assert [(r[0], r[2], r[3], r[4]) for r in rows] == [
        ("AUD", Decimal("10.50"), Decimal("89.50"), True), ("AUD", Decimal("0.00"), Decimal("80.00"), False), ("NZD", Decimal("9.00"), Decimal("0.00"), True),
    ]
    lines = "array<struct<id:string,unit_price:string,total:string,quantity:int>>"
    raw = '[{"id":"a","unit_price":"2","total":"4","quantity":2},{"id":"b","unit_price":"3","total":"3","quantity":1},{"id":"c","unit_price":"1","total":"1","quantity":1}]'
    recosted = one(
        spark, commerce.recost_cart(F.from_json(F.lit(raw), lines), F.create_map(F.lit("a"), F.lit(5), F.lit("b"), F.lit(0)), F.lit("1"), F.lit("2"))
    )[0]
    assert (recosted.quantity, recosted.subtotal, recosted.total) == (6, Decimal("11.00"), Decimal("10.00"))
    product = F.struct(F.lit("h").alias("handle"), F.lit("T").alias("title"), F.lit("").alias("vendor"), F.lit(9.999).alias("price"), F.lit("AUD").alias("currency"), F.lit("Tops").alias("category"))
    chosen = "struct<id:string,sku:string,title:string,price:double,currency:string>"
    variant = lambda s: F.from_json(F.lit(s), chosen)
    a, b = one(
        spark, commerce.ga_item(product, variant('{"id":"gid://x/Variant/47","sku":" ","title":"Default Title","price":5.0,"currency":"AUD"}'), F.lit(0)),
        commerce.ga_item(product, F.lit(None).cast(chosen), F.lit(2)),
    )
    assert (a.item_id, a.item_variant, a.item_brand, a.price, a.quantity) == ("47", None, None, Decimal("5.00"), 1)
    assert (b.item_id, b.price, b.quantity) == ("h", Decimal("10.00"), 2)
    assert one(spark, commerce.normalize_discount_code(F.lit(" SUMMER 20\t"))) == ("SUMMER20",)


def test_forms(spark):
    form = dict.fromkeys(forms.LIMITS, "ok text")
    cases = {
        "fine": {**form, "email": "a@b.co", "phone": "", "message": "long enough text"},
        "bad": {"first_name": " ", "last_name": "x" * 61, "email": "a@b", "phone": "12ab", "subject": "s\r\nBcc: x", "message": "short"},
    }
    df = spark.createDataFrame([(k, *[v[f] for f in forms.LIMITS]) for k, v in cases.items()], "name string, " + ", ".join(f"{f} string" for f in forms.LIMITS))
    values = forms.contact_values(F.struct(*forms.LIMITS))
    got = {r.name: (r.e, r.v) for r in df.select("name", forms.contact_errors(values).alias("e"), values.alias("v")).collect()}
    assert got["fine"][0] == {}
    assert set(got["bad"][0]) == {"first_name", "last_name", "email", "phone", "message"}
    assert got["bad"][1].subject == "s Bcc: x"
    secret, now = "k", 1_000_000_000_000
    sign = lambda t: f"{t}.{signature(str(t), secret)}"
    tokens = {
        "": "missing", "x.y": "malformed", str(now): "malformed", f"{now - 9000}.bad": "signature", sign(now - 1000): "too_fast",
        sign(now - 4_000_000): "expired", sign(now + 4000): "too_fast", sign(now + 9000): "malformed", sign(now - 9000): "ok",
    }
    assert one(spark, *[forms.verify_form_token(F.lit(t), F.lit(now), secret) for t in tokens]) == tuple(tokens.values())
    assert one(spark, forms.verify_form_token(F.lit(str(now - 9000)), F.lit(now), None)) == ("ok",)
    assert one(
        spark, forms.rate_limit_key(F.lit(" 1.1.1.1, 2.2.2.2"), F.lit("3")), forms.rate_limit_key(F.lit(None).cast("string"), F.lit(" 3 ")), forms.rate_limit_key(F.lit(""), F.lit(None).cast("string"))
    ) == ("1.1.1.1", "3", "unknown")


def test_webhook_signature_and_topics(spark):
    import base64
    import hashlib
    import hmac

    body = b'{"handle":" tee "}'
    good = base64.b64encode(hmac.new(b"k", body, hashlib.sha256).digest()).decode()
    long = base64.b64encode(hmac.new(b"x" * 80, body, hashlib.sha256).digest()).decode()
    wide = spark.createDataFrame([(bytearray(body), long)], "body binary, hmac string")
    assert wide.select(forms.verify_hmac(F.col("body"), F.col("hmac"), "x" * 80)).first()[0]
    df = spark.createDataFrame([(bytearray(body), h) for h in (good, "junk", None, good[:-4])], "body binary, hmac string")
    assert [r[0] for r in df.select(forms.verify_hmac(F.col("body"), F.col("hmac"), "k")).collect()] == [True, False, False, False]
    plans = one(
        spark, *[forms.topic_tags(F.lit(t), F.lit(p)) for t, p in (("Products/Update ", body.decode()), ("products/delete", '{"id":1}'), ("inventory_levels/update", "{}"), ("app/x", body.decode()), ("products/create", "{bad"))]
    )
    assert [p.tags for p in plans] == [["shop:products", "shop:product:tee"], ["shop:products"], ["shop:inventory", "shop:products"], [], ["shop:products"]]
    assert [p.known for p in plans] == [True, True, True, False, True]


def test_structured_data(spark):
    import json

    row = "path string, name string, description string, images array<string>, sku string, brand string, currency string, low double, high double, available boolean, offer_sku string, n int"
    df = spark.createDataFrame(
        [("/p/a", "A </script>", "", ["/i.jpg", " "], None, None, "AUD", 5.0, 5.0, True, "S1", 1), ("/p/b", "B", "x" * 1200, [], "K", "Acme", "AUD", 1.0, 2.5, False, None, 3)], row
    )
    one_, many = [json.loads(r[0]) for r in df.select(seo.product_json_ld("https://s", F.col("n"))).collect()]
    assert one_["offers"]["@type"] == "Offer" and one_["offers"]["price"] == "5.00" and one_["image"] == ["https://s/i.jpg"] and "description" not in one_ and one_["name"] == "A </script>"
    assert "<" not in df.select(seo.product_json_ld("https://s", F.col("n"))).first()[0]
    assert many["offers"] == {"@type": "AggregateOffer", "url": "https://s/p/b", "lowPrice": "1.00", "highPrice": "2.50", "priceCurrency": "AUD", "offerCount": 3, "availability": "https://schema.org/OutOfStock"}
    assert len(many["description"]) == 1000 and "image" not in many


def test_older_taxonomy(spark):
    from cartloom.rules import legacy

    tables = (legacy.CATEGORY_TYPES, legacy.TYPE_PRIORITY, legacy.NAME_TYPES)
    kinds = one(
        spark, options.product_type(words("Kneepads", "T-Shirts"), F.lit("x"), *tables), options.product_type(words("none"), F.lit("Coach Board"), *tables)
    )
    assert [tuple(k) for k in kinds] == [("protective-gear", "category"), ("coaching", "name-inferred")]


def test_other_structured_data(spark):
    import json

    post = "path string, headline string, description string, image string, date_published string, date_modified string, author string"
    df = spark.createDataFrame([("/blog/a", "H", "", None, "2024-01-01", None, "Jo"), ("/blog/b", "H", "d", "https://i", None, None, " ")], post)
    a, b = [json.loads(r[0]) for r in df.select(seo.article_json_ld("https://s")).collect()]
    assert a["author"] == {"@type": "Person", "name": "Jo"} and a["dateModified"] == "2024-01-01" and "image" not in a
    assert b["author"] == {"@id": "https://s#organization"} and b["image"] == ["https://i"] and "datePublished" not in b
    items = F.array(F.struct(F.lit("Home").alias("name"), F.lit("/").alias("path")), F.struct(F.lit("Now").alias("name"), F.lit(None).cast("string").alias("path")))
    crumbs = json.loads(one(spark, seo.breadcrumb_json_ld("https://s", items))[0])["itemListElement"]
    assert crumbs == [{"@type": "ListItem", "position": 1, "name": "Home", "item": "https://s"}, {"@type": "ListItem", "position": 2, "name": "Now"}]
    assert json.loads(one(spark, seo.site_json_ld("https://s", F.lit("Shop"), "/l.svg"))[0][1])["potentialAction"]["@type"] == "SearchAction"


def test_discount_eligibility(spark):
    shape = (
        "struct<type:string,amount:decimal(18,2),free_shipping:boolean,entitled_product_ids:array<bigint>,entitled_category_ids:array<bigint>,excluded_product_ids:array<bigint>>"
    )
    base = {"type": "percentage", "amount": 12.5, "free_shipping": False, "entitled_product_ids": [], "entitled_category_ids": [], "excluded_product_ids": []}
    import json

    cases = {
        "ok": {}, "free_shipping": {"free_shipping": True, "amount": 0}, "mixed_free_shipping": {"free_shipping": True}, "unsupported_type": {"type": "unsupported"},
        "category_restricted": {"entitled_category_ids": [1]}, "excluded_products": {"excluded_product_ids": [1]}, "unloaded_product": {"entitled_product_ids": [1, 9]},
    }
    loaded = F.array(F.lit(1).cast("bigint"))
    got = one(spark, *[commerce.discount_eligibility(F.from_json(F.lit(json.dumps({**base, **c})), shape), loaded) for c in cases.values()])
    assert [g.verdict for g in got] == list(cases)
    assert got[0].fraction == Decimal("0.1250") and got[-1].missing_products == [9]


def test_register_file(spark, tmp_path):
    from cartloom.sources.files import REGISTER, read_exception_register

    path = str(tmp_path / "register")
    rows = [("product", "1", "a", "load", "high", "x", 'say "hi",\nthen', "client", "resolved", "{}")]
    spark.createDataFrame(rows, REGISTER).write.csv(path, header=True, escape='"', quoteAll=True)
    assert [tuple(r) for r in read_exception_register(spark, path).collect()] == rows
    assert read_exception_register(spark, str(tmp_path / "none")).count() == 0


def test_crossing_elements_go_in_list_order(spark):
    from cartloom.functions.html import html_to_text, sanitize_html

    cases = {
        '<p>x</p><form>a<script>var t="</form>";</script>b</form><p>y</p>': ("<p>x</p><p>y</p>", "x y"),
        "<form>q<svg></form>w</svg>": ("q", "q"),
        "<!DOCTYPE html><!-- <script> --><p>k</p>": ("<p>k</p>", "k"),
        "<SCRIPT>a</script ><p>z</p><style>": ("<p>z</p>", "z"),
    }
    rows = spark.createDataFrame([(k,) for k in cases], "html string").select("html", sanitize_html(F.col("html")).alias("s"), html_to_text(F.col("html")).alias("t"))
    assert {r.html: (r.s, r.t) for r in rows.collect()} == cases
