"""MD5 hash buckets: category from the seller id, product from the order id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ordermart.constants import CATEGORIES, CATEGORY_HEX_CHARS, N_PRODUCTS, PRODUCT_ID_WIDTH


def _md5_prefix_int(c: Column) -> Column:
    """First 32 bits of md5(c) as a non-negative bigint."""
    return F.conv(F.substring(F.md5(c), 1, CATEGORY_HEX_CHARS), 16, 10).cast("bigint")


def padded(number: Column, width: int) -> Column:
    """Digits padded with zeros to at least ``width`` (``lpad`` alone would cut longer ones)."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def category_bucket(seller_id: Column) -> Column:
    names = F.array(*[F.lit(n) for n in CATEGORIES])
    return F.element_at(names, (_md5_prefix_int(seller_id) % len(CATEGORIES)).cast("int") + 1)


def product_bucket(order_id: Column, n_products: int = N_PRODUCTS) -> Column:
    return F.concat(F.lit("P"), padded(_md5_prefix_int(order_id) % n_products + 1, PRODUCT_ID_WIDTH))


def product_name(product_id: Column) -> Column:
    return F.concat(F.lit("Product "), product_id)
