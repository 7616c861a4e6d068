"""Labels and values of records as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    """A Column of a name, a Column or a number."""
    return c if isinstance(c, Column) else F.col(c) if isinstance(c, str) else F.lit(c)


def let(value: Column, body) -> Column:
    """body(value) with the value worked out once, however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lookup(values: Mapping) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def strip(text: Column | str) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(col(text), r"(?U)^\s+|\s+$", "")


def known_gender(gender: Column | str, known: Sequence[str] = ("M", "F")) -> Column:
    """The value if it is one of ``known``, else NULL."""
    return F.when(col(gender).isin(*known), col(gender))


def mapped_gender(gender: Column | str, synonyms: Mapping[str, str]) -> Column:
    """The synonym's value after stripping and lower case; NULL if there is none."""
    return F.try_element_at(lookup(synonyms), F.lower(strip(gender)))


def age(date: Column | str, birth: Column | str) -> Column:
    """Year of the date less the year of birth; NULL if either is no number."""
    return F.substring(col(date), 1, 4).try_cast("int") - col(birth).try_cast("int")


def count_or_null(items: Column | str) -> Column:
    """Length of a list: 0 for an empty one, NULL for NULL."""
    return F.when(col(items).isNotNull(), F.size(col(items)))


def capitalise(text: Column | str) -> Column:
    """First letter upper, the rest lower case."""
    return F.concat(F.upper(F.substring(col(text), 1, 1)), F.lower(F.substring(col(text), 2, 1 << 30)))


def remap(label: Column | str, values: Mapping[str, str]) -> Column:
    """The mapped label; labels without a mapping stay."""
    return F.coalesce(F.try_element_at(lookup(values), col(label)), col(label)) if values else col(label)


def scaled(label: Column | str, scale: Mapping[str, float] | None = None) -> Column:
    """A number for a label: of the scale, else the label as a number, else NULL."""
    number = col(label).try_cast("double")
    return F.coalesce(F.try_element_at(lookup(scale), col(label)), number) if scale else number


def label_index(label: Column | str, order: Sequence[str]) -> Column:
    """Place of a label in its order, from 0; NULL for NULL and for unknown labels."""
    at = F.array_position(F.array(*[F.lit(x) for x in order]), col(label))
    return F.when(at > 0, (at - 1).cast("int"))


def blank_to_null(text: Column | str, placeholder: str = "") -> Column:
    return F.nullif(col(text), F.lit(placeholder))


def first_filled(*texts: Column | str, default: str | None = None) -> Column:
    """The first text that is neither NULL nor empty."""
    return F.coalesce(*[blank_to_null(t) for t in texts], F.lit(default))


def duration(start_t, end_t, audio_length, frames=None, rate=None) -> Column:
    """Seconds: of the bounds, else audio_length, else of the frames; NULL if none is known."""
    ways = [col(end_t) - col(start_t), col(audio_length)]
    if frames is not None:
        ways.append(F.when(col(rate) > 0, F.size(col(frames)) / col(rate)))
    return F.coalesce(*ways)


def seconds(time: Column | str, digits: int = 3) -> Column:
    """Rounded half to even; NULL stays."""
    return F.bround(col(time), digits)


def word_text(text: Column | str, char_s: Column | str, char_e: Column | str, own: Column | None = None) -> Column:
    """A word's own text, else the slice [char_s, char_e) of the utterance."""
    cut = F.substring(col(text), col(char_s) + 1, F.greatest(col(char_e) - col(char_s), F.lit(0)))
    return F.coalesce(blank_to_null(own), cut) if own is not None else cut


def regression_label(number: Column | str, label: Column | str, scale: Mapping[str, float]) -> Column:
    """One number for labels of two kinds: the number if it is one, else the label's place on the scale, else NULL."""
    return F.coalesce(col(number).try_cast("double"), F.try_element_at(lookup(scale), col(label)))
