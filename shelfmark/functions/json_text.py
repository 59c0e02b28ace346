"""Reading a few fields out of JSON text of uneven shape."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NO_TEXTS = "array<string>"
# Stating the default mode keeps the optimizer from narrowing a schema with _corrupt_record.
WHOLE = {"mode": "PERMISSIVE"}


# Names what is put around a text. A text can only name it by the character itself or by its escape,
# which has no letters and so one spelling.
_MARK = "\u2063"
_MARK_ESCAPE = "\\u2063"


def parse_whole(text: Column, fields: str) -> Column:
    """One parse of a text as an object with these fields, from which ``is_whole`` can tell that it was one value.

    The text becomes the first element of a list in an object; a second element ends the list. What
    follows a first value in the text then lengthens the list, breaks it, or ends it before its end.
    """
    wrapped = F.concat(F.lit(f'{{"{_MARK}":['), text, F.lit(f',{{"{_MARK}":0}}]}}'))
    schema = f"`{_MARK}` ARRAY<STRUCT<{fields}, `{_MARK}` INT>>, _corrupt_record STRING"
    return F.from_json(wrapped, schema, WHOLE)


def is_whole(parsed: Column, text: Column) -> Column:
    """Whether ``parse_whole`` proved the text to be one JSON value of the wanted shape throughout.

    Where it is false the text may still be sound, of another shape or using the mark. Never null.
    """
    both = parsed[_MARK]
    ended = (F.size(both) == 2) & F.get(both, F.lit(1))[_MARK].isNotNull()
    named = F.contains(text, F.lit(_MARK)) | F.contains(text, F.lit(_MARK_ESCAPE))
    return F.coalesce(parsed["_corrupt_record"].isNull() & ended & ~named, F.lit(False))


def as_variant(text: Column) -> Column:
    """One parse of a text of any shape, as the first of two elements; null if it breaks their list or repeats a name."""
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(f',"{_MARK}"]')))


def is_one_value(parsed: Column, text: Column) -> Column:
    """Whether ``as_variant`` proved the text to be one JSON value; where it is false the text may still be. Never null."""
    named = F.contains(text, F.lit(_MARK)) | F.contains(text, F.lit(_MARK_ESCAPE))
    return F.coalesce((F.try_variant_get(parsed, "$[1]", "string") == F.lit(_MARK)) & ~named, F.lit(False))


def field_of(parsed: Column, path: str, kind: str = "string") -> Column:
    """A field of what ``as_variant`` read; null where there is none or, at any depth, none of that kind."""
    return F.try_variant_get(parsed, f"$[0].{path}", kind)


def whole_value(parsed: Column) -> Column:
    """The object that ``parse_whole`` read."""
    return F.get(parsed[_MARK], F.lit(0))


def parts_of_list(text: Column) -> Column:
    """The elements of a JSON list as raw JSON texts; NULL for anything that is not a list."""
    return F.when(F.startswith(F.ltrim(text), F.lit("[")), F.from_json(text, "array<string>"))


def parts_of_field(text: Column, field: str) -> Column:
    """The elements of a list-valued field; an empty list for any other shape."""
    parts = F.from_json(text, f"`{field}` array<string>").getField(field)
    return F.coalesce(parts, F.array().cast(_NO_TEXTS))


def has_field(text: Column, field: str) -> Column:
    """Whether a JSON object names ``field``, also when its value is a JSON null."""
    return F.array_contains(F.json_object_keys(text), field)


def not_json(text: Column) -> Column:
    """Whether a non-null text is anything else than exactly one JSON value.

    The parser stops after the first value and says nothing about what follows. So the text is put
    where more than one value would show: as the only element of a list, which a comma or a further
    value would lengthen or break, and as the only field of an object, which a closing bracket would
    break. Names may repeat within an object; the last one counts.
    """
    elements = F.size(F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>"))
    fault = F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), "v string, _corrupt_record string", WHOLE)
    one = (elements == 1) & fault["_corrupt_record"].isNull() & fault.isNotNull()
    return text.isNotNull() & (~F.coalesce(one, F.lit(False)) | (F.trim(text) == ""))
