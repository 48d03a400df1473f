"""JSON text checks shared by record decoding and item labels."""

from pyspark.sql import Column
from pyspark.sql import functions as F


# Spark also takes 'single quoted' texts unless told not to; JSON has none.
PLAIN_JSON = {"allowSingleQuotes": "false"}
# A value that no record holds by accident; a text that holds it anyway is looked at twice.
_LAST = "\u0001end of record\u0001"


def is_alone(text: Column) -> Column:
    """True when nothing follows the first JSON value of a text that starts with one.

    Spark's JSON functions stop after the first value. Here the text becomes the first item of
    an array whose second item is known: trailing bytes are then a syntax error, and a second
    value takes the place of the known one. One pass, which builds nothing.
    """

    def second(last: str) -> Column:
        wrapped = F.concat(F.lit("["), text, F.lit(f',"{_escaped(last)}"]'))
        return F.coalesce(F.get_json_object(wrapped, "$[1]") == last, F.lit(False))

    # A text cannot hold two different ends in the same place.
    twice = F.contains(text, F.lit("end of record"))
    return second(_LAST) & (~twice | second(_LAST + "2"))


def _escaped(text: str) -> str:
    return text.replace("\u0001", "\\u0001")


def is_single_object(text: Column) -> Column:
    """True when a text that parses as a JSON object holds nothing after it.

    A flat object is settled by its only closing brace being the last byte.
    """
    flat = F.position(F.lit("}"), text) == F.length(text)
    closed = F.endswith(text, F.lit("}")) | F.rlike(text, F.lit(r"\}\s+$"))
    return F.coalesce(flat | (closed & is_alone(text)), F.lit(False))
