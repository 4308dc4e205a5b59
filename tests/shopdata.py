"""A small shop written as snapshot files: our own rows, one per edge case."""

import json


def named(*names):
    return [{"id": i, "name": n, "slug": n.lower().replace(" ", "-")} for i, n in enumerate(names, 1)]


def attribute(name, *values, axis=True):
    return {"id": 0, "name": name, "slug": name.lower(), "position": 0, "visible": True, "variation": axis, "options": list(values)}


def variant(id_, parent, order, sku="", options=None, **extra):
    given = [{"id": 0, "name": n, "slug": n.lower(), "option": v} for n, v in (options or {}).items()]
    row = {"id": id_, "parent_id": parent, "menu_order": order, "sku": sku, "attributes": given, "tax_status": "taxable"}
    return {**row, "regular_price": "20", "sale_price": "", "price": "20", **extra}


SITE = "https://www.old-shop.invalid"
UP = f"{SITE}/wp-content/uploads"

PRODUCTS = [
    {
        "id": 10, "name": "Beach Tee &amp; Sand", "slug": "beach-tee", "status": "publish", "type": "variable",
        "description": "<p>soft</p>", "permalink": f"{SITE}/product/beach-tee/", "weight": "0.2",
        "attributes": [attribute("Color", "Black", "Navy Blue"), attribute("Size", "SM", "XXL", "S")],
        "categories": named("T-Shirts"), "tags": named("Summer Sale"), "brands": named("Acme"),
        "images": [{"id": 1, "src": f"{UP}/tee.jpg", "alt": "Tee", "name": "tee"}], "variations": [101, 102, 103],
        "yoast_head_json": {"title": "Tee", "description": "A tee"}, "tax_status": "taxable",
    },
    {
        "id": 11, "name": "Kit Jersey", "slug": "kit-jersey", "status": "publish", "type": "variable",
        "attributes": [attribute("Color", "Gray", "Light Gray"), attribute("Condition", "Used", "New")],
        "categories": named("Jerseys", "Teamwear"), "images": [], "variations": [111, 112],
        "regular_price": "55.5",
    },
    {
        "id": 12, "name": "Unisex Cap", "slug": "beach-tee", "status": "draft", "type": "variable",
        "attributes": [attribute("Hats", "Unisex Hats"), attribute("Gender", "male", axis=False)],
        "categories": named("Odd Things"), "regular_price": "15", "variations": [121],
        "images": [{"id": 2, "src": f"{UP}/cap.jpg", "alt": "", "name": "cap"}],
    },
    {
        "id": 13, "name": "Plain Sock", "slug": "plain-sock", "status": "publish", "type": "simple", "sku": "SOCK",
        "price": "7", "regular_price": "7", "stock_quantity": -3, "manage_stock": True, "categories": named("Socks"),
        "images": [{"id": 3, "src": f"{UP}/gone.jpg", "alt": "x", "name": "s"}], "meta_data": [],
    },
    {
        "id": 14, "name": "Gift Bundle", "slug": "gift-bundle", "status": "publish", "type": "easy_product_bundle",
        "categories": named("Gifts"), "price": "99", "images": [],
    },
]
VARIATIONS = [
    variant(101, 10, 1, "TEE-1", {"Color": "Black", "Size": "XXL"}, sale_price="15", image={"id": 5, "src": f"{UP}/black.jpg", "alt": ""}),
    variant(102, 10, 0, "", {"Color": "Navy Blue", "Size": "SM"}, weight="0.35"),
    variant(103, 10, 2, "DUP", {"Color": "Black", "Size": "S"}),
    variant(111, 11, 0, "DUP", {"Color": "Gray"}, regular_price="", price=""),
    variant(112, 11, 1, "J-2", {"Color": "Light Gray"}, stock_quantity=4, manage_stock=True),
    variant(121, 12, 0, "CAP", {"Hats": "Unisex Hats"}, regular_price="", price=""),
]
PAGES = [
    {
        "id": 30, "slug": "about", "title": {"rendered": "About &amp; us"}, "status": "publish", "link": f"{SITE}/about/",
        "content": {
            "rendered": f'<p><img src="{UP}/tee-300x200.jpg" srcset="{UP}/tee-300x200.jpg 300w, {UP}/tee.jpg 900w" sizes="9vw">'
            f'<img src="/wp-content/uploads/lost-20x20.png"><a href="{UP}/guide.pdf">guide</a></p>',
            "raw": '[gallery] <a href="/faq">q</a>',
        },
    },
    {"id": 31, "slug": "cart-2", "title": {"rendered": "Cart"}, "status": "publish", "content": {"rendered": "", "raw": ""}},
]
POSTS = [
    {
        "id": 40, "slug": "first", "title": {"rendered": "First"}, "status": "publish", "author": 7, "tags": [1, 9], "categories": [1],
        "content": {"rendered": "<p>hi</p>", "raw": "hi"}, "excerpt": {"rendered": "short"}, "date_gmt": "2024-01-02T00:00:00",
    }
]


def address(line="1 Road", **extra):
    return {"first_name": "A", "last_name": "B", "address_1": line, "city": "X", "country": "", **extra}


CUSTOMERS = [
    {"id": 50, "role": "customer", "email": "One@Example.invalid", "billing": address(phone="123"), "shipping": address("")},
    {"id": 51, "role": "customer", "email": "one@example.invalid", "billing": address(), "shipping": {}},
    {"id": 52, "role": "administrator", "email": "boss@example.invalid"},
    {"id": 53, "role": "customer", "email": ""},
    {"id": 54, "role": "customer", "email": "two@example.invalid", "billing": address(""), "shipping": {}},
]
COUPONS = [
    {
        "id": 60, "code": "TEN", "discount_type": "percent", "amount": "10", "status": "publish", "minimum_amount": "0.00", "usage_limit_per_user": 1,
        "meta_data": [{"id": 1, "key": "_acfw_rule", "value": "yes"}, {"id": 2, "key": "_acfw_off", "value": "no"}],
    },
    {"id": 61, "code": "ODD", "discount_type": "sign_up_fee", "amount": "5", "status": "draft"},
]
MEDIA = [
    {"id": 1, "source_url": f"{UP}/tee.jpg", "alt_text": "Tee alt", "mime_type": "image/jpeg"},
    {"id": 2, "source_url": f"{UP}/cap.jpg", "alt_text": "Cap alt", "mime_type": "image/jpeg"},
    {"id": 6, "source_url": f"{UP}/guide.pdf", "alt_text": "", "mime_type": "application/pdf"},
]
MEDIA_HEAD = [{"url": f"{UP}/gone.jpg", "status": 404, "type": "", "bytes": 0}, {"url": f"{UP}/tee.jpg", "status": 200, "type": "", "bytes": 9}]


def line(id_, subtotal, total, quantity=1, **extra):
    return {"id": id_, "name": "Tee", "product_id": 10, "variation_id": 101, "quantity": quantity, "sku": "TEE-1", "price": float(subtotal),
            "subtotal": subtotal, "total": total, "total_tax": "0.00", **extra}


ORDERS = [
    {
        "id": 70, "number": "N-70", "status": "completed", "currency": "AUD", "date_created_gmt": "2024-01-01T10:00:00", "date_paid_gmt": "2024-01-01T10:05:00",
        "customer_id": 50, "total": "33.00", "discount_total": "2.00", "shipping_total": "5.00", "total_tax": "0.00", "payment_method": "card",
        "customer_note": "=cmd()\nsecond", "billing": address("@home", email="a@b.invalid"), "shipping": address(),
        "line_items": [line(1, "20.00", "18.00", meta_data=[{"id": 1, "key": "pa_size", "value": "XL", "display_key": "Size", "display_value": "XL"}, {"id": 2, "key": "_x", "value": "1"}]), line(2, "10.00", "10.00")],
        "shipping_lines": [{"id": 3, "method_id": "local_pickup", "method_title": "Pickup", "total": "5.00", "total_tax": "0"}],
        "refunds": [{"id": 90, "reason": "", "total": "-10.00"}],
    },
    {
        "id": 71, "status": "cancelled", "currency": "AUD", "date_created_gmt": "2024-01-02T10:00:00", "customer_id": 0, "total": "7.00",
        "line_items": [line(4, "7.00", "7.00", 2)], "fee_lines": [{"id": 5, "name": "Fee", "total": "1.00", "total_tax": "0"}],
    },
    {"id": 72, "status": "processing", "currency": "NZD", "date_created_gmt": "2024-01-03T10:00:00", "customer_id": 50, "total": "1,000.50", "line_items": []},
]
REFUNDS = [
    {"id": 90, "amount": "10.00", "reason": "+ok", "date_created_gmt": "2024-02-01T00:00:00", "line_items": [line(8, "-10.00", "-10.00", -1)]},
    {"id": 91, "amount": "1.00", "_links": {"up": [{"href": f"{SITE}/wp-json/wc/v3/orders/72"}]}, "line_items": []},
    {"id": 92, "amount": "5.00", "line_items": []},
]
GATEWAYS = [{"id": "card", "title": "Card", "method_title": "Credit card", "enabled": True}]

ENTITIES = {
    "products": PRODUCTS, "variations": VARIATIONS, "pages": PAGES, "posts": POSTS, "customers": CUSTOMERS, "coupons": COUPONS, "media": MEDIA,
    "media_head": MEDIA_HEAD, "orders": ORDERS, "refunds": REFUNDS, "payment_gateways": GATEWAYS,
    "post_tags": [{"id": 1, "name": "News", "slug": "news"}], "post_categories": [{"id": 1, "name": "General", "slug": "general"}],
    "product_categories": [{"id": 1, "name": "T-Shirts", "slug": "t-shirts", "parent": 0, "count": 3}, {"id": 2, "name": "Kids", "slug": "kids", "parent": 1, "count": 0}],
    "product_tags": [{"id": 1, "name": "Polo day", "slug": "polo-day", "count": 2}, {"id": 2, "name": "Gone", "slug": "gone", "count": 0}],
    "sitemap_urls": [{"sitemap": "product-sitemap.xml", "loc": f"{SITE}/product/beach-tee/", "lastmod": ""}, {"sitemap": "misc.xml", "loc": f"{SITE}/old-thing/", "lastmod": ""}],
    "menu_items": [{"id": 1, "title": "m", "url": f"{SITE}/about/?utm_source=x"}],
    "plugins": [{"name": "Add-on Fields &amp; Co", "status": "active", "version": "1"}, {"name": "Other", "status": "inactive", "version": "2"}],
}


def write(folder, entities=None, skip=()):
    for name, rows in {**ENTITIES, **(entities or {})}.items():
        if name not in skip:
            (folder / f"{name}.json").write_text(json.dumps(rows))
    (folder / "_manifest.json").write_text(json.dumps({"started": "s", "finished": "2026-01-01", "base": SITE}))
    return str(folder)
