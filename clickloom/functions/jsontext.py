"""Scalar look-ups in JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OID_PATTERN = r'"\$oid"\s*:\s*"([^"]+)"'
_OID_ALONE = r'^\{"\$oid":\s?"([0-9A-Za-z]+)"\}$'

#: How an array's parse spells what is beyond a double; an element's own leaves out the quotes.
_NO_NUMBERS = ['"NaN"', '"Infinity"', '"-Infinity"']

#: An array of objects, their fields as text.
OBJECTS = "array<map<string,string>>"


def _opens_container(text: Column) -> Column:
    return text.substr(1, 1).isin("{", "[")


def json_objects(text: Column, names: list[str]) -> Column:
    """A JSON array's elements as structs of ``line``, the JSON text, and the named fields.

    A field is the first of its key, as it was sent (fractions in Spark's spelling), objects
    and arrays as JSON text; NULL for an element that is no object. Each element is parsed
    once, each field looked up once.
    """
    parsed = F.transform(
        json_elements(text),
        lambda line: F.struct(
            line.alias("line"), F.from_json(line, "map<string,string>").alias("fields")
        ),
    )
    return F.transform(
        parsed,
        lambda e: F.struct(
            e["line"].alias("line"), *[F.try_element_at(e["fields"], F.lit(n)).alias(n) for n in names]
        ),
    )


def field_scalar(element: Column, name: str, line: Column | None = None) -> Column:
    """A field's scalar as text; NULL if absent, null, an object or an array.

    Text that merely looks like a container may be a string, so for those few values the
    whole element, parsed with its types, decides. ``line`` is the JSON text of an element of
    ``json_maps``, which doesn't hold it.
    """
    text = element[name]
    if line is None:
        line = element["line"]
    else:
        again = F.from_json(line, "map<string,string>")[name]
        text = F.when(text.isin(_NO_NUMBERS), again).otherwise(text)
    typed = F.try_variant_get(F.try_parse_json(line), f"$.{name}", "variant")
    container = F.schema_of_variant(typed).rlike("^(OBJECT|ARRAY)")
    # nested, as Spark would parse for every element what several fields share beside an `and`
    checked = F.when(F.coalesce(container, F.lit(True)), None).otherwise(text)
    return F.when(_opens_container(text), checked).otherwise(text)


def json_elements(text: Column) -> Column:
    """A JSON array's elements as JSON texts; NULL unless it is an array.

    Texts keep numbers as sent and an element that repeats a key.
    """
    return F.when(is_json_array(text), F.from_json(text, "array<string>"))


def is_json_array(text: Column) -> Column:
    """True for a JSON array, also an empty one; NULL only for NULL text."""
    return F.when(text.isNotNull(), F.json_array_length(text).isNotNull())


def json_maps(text: Column, whole: Column) -> Column:
    """A JSON array's elements as maps of their fields' texts; NULL for an element that is no object.

    ``whole`` is a column that holds the text read as ``OBJECTS``: one parse for all
    elements. It leaves out what is no object; only then each element is parsed by itself,
    so that positions stay. A key that comes twice stays twice, the first is looked up.
    """
    one_by_one = F.transform(json_elements(text), lambda line: F.from_json(line, "map<string,string>"))
    return F.when(F.size(whole) == F.json_array_length(text), whole).otherwise(one_by_one)


def has_object_id(text: Column) -> Column:
    """``object_id(text)`` is not NULL, as a filter: one match settles nearly all rows.

    Pushed down, a filter's column is computed again for every mention of it.
    """
    return F.rlike(text, F.lit(_OID_ALONE)) | object_id(text).isNotNull()


def object_id(text: Column) -> Column:
    """The hex id in an extended-JSON ``{"$oid": "..."}`` wrapper, else NULL."""
    # nearly all are the wrapper and nothing else; only others are parsed
    plain = F.nullif(F.regexp_extract(text, _OID_ALONE, 1), F.lit(""))
    from_path = F.get_json_object(text, "$.$oid")
    scalar = F.when(~_opens_container(from_path), from_path)
    from_text = F.nullif(F.regexp_extract(text, _OID_PATTERN, 1), F.lit(""))
    return F.coalesce(plain, scalar, from_text)
