"""Text: line codes, readable names, tags, archive file names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from dwelltime import fixed_values as fixed

BLANKS = " \t\r\n"
_CASED = r"\p{Lu}\p{Ll}\p{Lt}"


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def line_code(route_id: Column) -> Column:
    """The line as riders spell it: `720-13201` is line 720, `801` is itself."""
    return strip(F.split_part(route_id, F.lit("-"), F.lit(1)))


def either(text: Column, fallback: Column) -> Column:
    """The text, or the fallback where it is missing or empty, without outer blanks."""
    return strip(F.coalesce(F.nullif(text, F.lit("")), fallback))


def readable(text: Column) -> Column:
    """Title case after anything that is not a letter, with initialisms put back."""
    runs = F.regexp_extract_all(text, F.lit(f"([{_CASED}]+|[^{_CASED}]+)"), F.lit(1))
    titled = F.array_join(F.transform(runs, F.initcap), "")
    words = F.filter(F.split(titled, r"\s+"), lambda word: word != "")
    pairs = [F.lit(part) for pair in fixed.RESTORED_WORDS.items() for part in pair]
    restored = F.create_map(*pairs)
    return F.array_join(
        F.transform(words, lambda word: F.coalesce(F.try_element_at(restored, word), word)), " ")


def clean_etag(raw: Column) -> Column:
    """The bare tag: no weak mark, no quotes, empty where there is none."""
    return F.regexp_replace(strip(F.coalesce(raw, F.lit(""))), r'^W/|"', "")


def natural_order(code: Column) -> list[Column]:
    """Sort keys: shorter codes first, then by character."""
    return [F.length(code), code]


def archive_day(file_name: Column) -> Column:
    """UTC day in an archive file's name, NULL for any other name."""
    digits = F.regexp_extract(file_name, fixed.ARCHIVE_FILE, 1)
    return F.try_to_date(F.nullif(digits, F.lit("")), "yyyyMMdd")


def archive_hour(file_name: Column) -> Column:
    return F.nullif(F.regexp_extract(file_name, fixed.ARCHIVE_FILE, 2), F.lit("")).try_cast("int")
