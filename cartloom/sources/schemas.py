"""Explicit schemas of the snapshot entities. Money and weight arrive as text."""

from __future__ import annotations

from pyspark.sql.types import StructType

_TEXT = "struct<rendered:string,raw:string>"
_META = "array<struct<id:bigint,key:string,value:string,display_key:string,display_value:string>>"
_NAMED = "array<struct<id:bigint,name:string,slug:string>>"
_ADDRESS = (
    "struct<first_name:string,last_name:string,company:string,address_1:string,address_2:string,"
    "city:string,state:string,postcode:string,country:string,email:string,phone:string>"
)
_SEO = "struct<title:string,description:string,og_description:string,author:string>"
_LINES = (
    "array<struct<id:bigint,name:string,parent_name:string,product_id:bigint,variation_id:bigint,"
    f"quantity:int,sku:string,price:double,subtotal:string,total:string,total_tax:string,meta_data:{_META}>>"
)

DDL = {
    "products": (
        "id bigint, name string, slug string, status string, type string, sku string, price string,"
        " regular_price string, sale_price string, description string, permalink string,"
        " date_created_gmt string, date_modified string, on_sale boolean, featured boolean,"
        " attributes array<struct<id:bigint,name:string,slug:string,position:int,visible:boolean,"
        "variation:boolean,options:array<string>>>,"
        f" categories {_NAMED}, tags {_NAMED}, brands {_NAMED},"
        " images array<struct<id:bigint,src:string,alt:string,name:string>>, variations array<bigint>,"
        " manage_stock boolean, stock_quantity int, stock_status string, backorders_allowed boolean,"
        " weight string, virtual boolean, tax_status string, tax_class string,"
        f" meta_data {_META}, yoast_head_json {_SEO}, global_unique_id string"
    ),
    "variations": (
        "id bigint, parent_id bigint, status string, sku string, price string, regular_price string,"
        " sale_price string, weight string, manage_stock boolean, stock_quantity int,"
        " stock_status string, backorders string, backorders_allowed boolean, virtual boolean, tax_status string,"
        " attributes array<struct<id:bigint,name:string,slug:string,option:string>>,"
        " image struct<id:bigint,src:string,alt:string>, menu_order int,"
        f" meta_data {_META}, global_unique_id string"
    ),
    "product_categories": "id bigint, name string, slug string, parent bigint, count bigint",
    "product_tags": "id bigint, name string, slug string, count bigint",
    "post_tags": "id bigint, name string, slug string, count bigint",
    "post_categories": "id bigint, name string, slug string, parent bigint, count bigint",
    "media": (
        f"id bigint, source_url string, alt_text string, post bigint, media_type string, mime_type string,"
        f" title {_TEXT}, guid {_TEXT}, date string,"
        " media_details struct<file:string,width:int,height:int,filesize:bigint>"
    ),
    "media_head": "url string, status int, type string, bytes bigint",
    "pages": (
        f"id bigint, slug string, title {_TEXT}, content {_TEXT}, status string, date_gmt string,"
        f" modified string, link string, author bigint, template string, yoast_head_json {_SEO}"
    ),
    "posts": (
        f"id bigint, slug string, title {_TEXT}, content {_TEXT}, excerpt {_TEXT}, status string,"
        " date_gmt string, modified string, link string, author bigint, template string,"
        f" tags array<bigint>, categories array<bigint>, yoast_head_json {_SEO}"
    ),
    "customers": (
        "id bigint, role string, email string, first_name string, last_name string, username string,"
        f" date_created_gmt string, is_paying_customer boolean, billing {_ADDRESS}, shipping {_ADDRESS},"
        f" meta_data {_META}"
    ),
    "coupons": (
        "id bigint, code string, discount_type string, amount string, status string,"
        " free_shipping boolean, individual_use boolean, date_created_gmt string,"
        " date_expires_gmt string, minimum_amount string, maximum_amount string, usage_limit int,"
        " usage_limit_per_user int, product_ids array<bigint>, product_categories array<bigint>,"
        f" excluded_product_ids array<bigint>, meta_data {_META}"
    ),
    "orders": (
        "id bigint, number string, parent_id bigint, status string, currency string,"
        " date_created_gmt string, date_modified_gmt string, date_paid_gmt string,"
        " date_completed_gmt string, created_via string, customer_id bigint, customer_note string,"
        " order_key string, payment_method string, payment_method_title string,"
        " transaction_id string, prices_include_tax boolean, discount_total string,"
        " discount_tax string, shipping_total string, shipping_tax string, cart_tax string,"
        f" total_tax string, total string, billing {_ADDRESS}, shipping {_ADDRESS},"
        f" line_items {_LINES},"
        " shipping_lines array<struct<id:bigint,method_id:string,method_title:string,total:string,total_tax:string>>,"
        " fee_lines array<struct<id:bigint,name:string,total:string,total_tax:string>>,"
        " coupon_lines array<struct<id:bigint,code:string,discount:string>>,"
        f" refunds array<struct<id:bigint,reason:string,total:string>>, meta_data {_META}"
    ),
    "refunds": (
        "id bigint, date_created_gmt string, amount string, reason string, refunded_by bigint,"
        f" refunded_payment boolean, meta_data {_META}, line_items {_LINES},"
        " _links struct<up:array<struct<href:string>>>"
    ),
    "payment_gateways": "id string, title string, method_title string, enabled boolean",
    "menu_items": "id bigint, title string, url string",
    "sitemap_urls": "sitemap string, loc string, lastmod string",
    "plugins": "name string, status string, version string",
}

#: entities a catalog run cannot do without
CATALOG_REQUIRED = ["products", "variations", "media", "pages", "posts", "customers", "coupons"]
CATALOG_OPTIONAL = [
    "product_categories", "product_tags", "post_tags", "post_categories", "media_head",
    "menu_items", "sitemap_urls", "plugins",
]
ARCHIVE_REQUIRED = ["orders", "refunds"]
ARCHIVE_OPTIONAL = ["customers", "payment_gateways"]


def schema(entity: str) -> StructType:
    return StructType.fromDDL(DDL[entity])
