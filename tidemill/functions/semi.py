"""Lists packed in strings, nested JSON records, and the product record drawn from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemill.functions.text import describe_product, first_truthy, let, strip

JSON_OPTIONS = {"allowBackslashEscapingAnyCharacter": "true"}

# The fields a product record may use, in order of preference.
ID_FIELDS = ["id", "product_id", "sku"]
NAME_FIELDS = ["name", "title"]
URL_FIELDS = ["url_key", "url_path", "short_url"]
PRICE_FIELDS = ["price", "final_price", "original_price", "list_price", "current_price"]
DESCRIPTION_FIELDS = ["description", "short_description", "long_description"]
IMAGE_FIELDS = ["large_url", "base_url", "medium_url", "thumbnail_url", "url"]
THUMBNAIL_FIELDS = ["thumbnail_url", "thumbnail", "image", "thumb"]

_RECORD = ", ".join(
    f"{name} STRING"
    for name in dict.fromkeys(
        ID_FIELDS + NAME_FIELDS + URL_FIELDS + PRICE_FIELDS + DESCRIPTION_FIELDS
        + THUMBNAIL_FIELDS + ["images"]
    )
)


def _filled(items: Column) -> Column:
    return F.filter(F.transform(items, lambda item: strip(item)), lambda item: item != "")


def list_items(text: Column) -> Column:
    """Names in a list-like string.

    Reads a bracketed list of strings or of objects with ``name`` or ``title``; otherwise
    splits on ``|``, else on ``,`` (not for text starting with ``{``), else takes the text.
    """
    trimmed = strip(text)
    parsed = F.from_json(trimmed, "array<string>", JSON_OPTIONS)
    named = F.transform(
        parsed,
        lambda item: F.when(
            item.startswith("{"),
            first_truthy(F.get_json_object(item, "$.name"), F.get_json_object(item, "$.title")),
        ).otherwise(item),
    )
    bracketed = F.transform(
        F.filter(named, lambda item: item.isNotNull()), lambda item: strip(item)
    )
    return (
        F.when(trimmed.startswith("[") & parsed.isNotNull(), bracketed)
        .when(F.contains(trimmed, F.lit("|")), _filled(F.split(trimmed, r"\|")))
        .when(
            F.contains(trimmed, F.lit(",")) & ~trimmed.startswith("{"),
            _filled(F.split(trimmed, ",")),
        )
        .when(trimmed.isNotNull(), F.array(trimmed))
    )


def unquoted_items(text: Column) -> Column:
    """Split on ``|`` or else ``,`` after turning brackets and quotes into nothing."""
    quoted = F.translate(text, "[]'", '"""')
    pieces = F.when(F.contains(quoted, F.lit("|")), F.split(quoted, r"\|")).otherwise(
        F.split(quoted, ",")
    )
    return F.transform(_filled(pieces), lambda item: F.regexp_replace(item, '^"+|"+$', ""))


def _inner_object(json: Column, field: str) -> Column:
    return let(F.get_json_object(json, f"$.{field}"), lambda inner: F.when(inner.startswith("{"), inner).otherwise(json))


def unwrap(json: Column) -> Column:
    """Step into ``data`` and then ``product`` where those are objects; each is looked up once."""
    return let(_inner_object(json, "data"), lambda inner: _inner_object(inner, "product"))


def image_urls(images: Column, thumbnails: list[Column]) -> Column:
    """URLs of the image list, with every thumbnail that is not listed yet put in front.

    The list may hold texts and objects; numbers and other values are no images.
    """
    def url(item: Column) -> Column:
        kind = F.schema_of_variant(item)
        fields = [F.try_variant_get(item, f"$.{f}", "string") for f in IMAGE_FIELDS]
        return F.when(kind == "STRING", F.try_variant_get(item, "$", "string")).when(
            kind.startswith("OBJECT"), first_truthy(*fields)
        )

    def with_thumbnail(urls: Column, thumbnail: Column) -> Column:
        def put(found: Column) -> Column:
            wanted = (F.coalesce(thumbnail, F.lit("")) != "") & ~F.array_contains(found, thumbnail)
            return F.when(wanted, F.concat(F.array(thumbnail), found)).otherwise(found)

        return let(urls, put)

    urls = F.transform(F.from_json(images, "array<variant>", JSON_OPTIONS), url)
    urls = F.coalesce(F.filter(urls, lambda url: url.isNotNull()), F.array().cast("array<string>"))
    return reduce(with_thumbnail, thumbnails, urls)


def product_struct(json: Column) -> Column:
    """All known fields of a raw product record, as text; null unless it is an object."""
    inner = unwrap(json)
    return F.when(F.trim(json).startswith("{"), F.from_json(inner, _RECORD, JSON_OPTIONS))


def product_columns(record: str) -> dict[str, Column]:
    """The cleaned product columns, given the name of a ``product_struct`` column."""
    field = lambda name: F.col(f"{record}.{name}")
    filled_id = [F.when(field(f) != "0", field(f)) for f in ID_FIELDS]
    price = F.coalesce(*[field(f) for f in PRICE_FIELDS])
    return {
        "id": first_truthy(*filled_id).try_cast("bigint"),
        "name": first_truthy(*[field(f) for f in NAME_FIELDS]),
        "url_key": first_truthy(*[field(f) for f in URL_FIELDS]),
        "price": price.try_cast("double").try_cast("bigint"),
        "description": describe_product(first_truthy(*[field(f) for f in DESCRIPTION_FIELDS])),
        "images": image_urls(field("images"), [field(f) for f in THUMBNAIL_FIELDS]),
    }


def zip_lists(*lists: Column, names: list[str], missing: str = "N/A") -> Column:
    """Pair ragged lists by position as an array of structs; gaps hold ``missing``."""
    longest = F.greatest(*[F.coalesce(F.size(c), F.lit(0)) for c in lists], F.lit(0))
    positions = F.when(longest > 0, F.sequence(F.lit(0), longest - 1)).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(
        positions,
        lambda i: F.struct(
            *[F.coalesce(F.get(c, i), F.lit(missing)).alias(n) for c, n in zip(lists, names)]
        ),
    )
