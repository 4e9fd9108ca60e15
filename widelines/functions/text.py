"""Text expressions used by the wide tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def customer_name(first: Column | str = "first_name", last: Column | str = "last_name") -> Column:
    """``first || ' ' || last``: NULL when either part is NULL (unlike concat_ws)."""
    return F.concat(F.col(first) if isinstance(first, str) else first, F.lit(" "),
                    F.col(last) if isinstance(last, str) else last)


def pad_code(prefix: str, key: Column | str, width: int) -> Column:
    """``prefix`` and the key, zero-padded to ``width``; a longer key is kept whole, so codes stay one-to-one."""
    text = (F.col(key) if isinstance(key, str) else key).cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0")))


def mask_email(col: Column | str = "email", secret: str = "widelines") -> Column:
    """Keep the domain, replace the local part by its whole SHA-256, keyed with ``secret``.

    Equal addresses stay equal and different ones different; without the secret the (guessable) local parts
    cannot be tried out.  Pass a private ``secret`` in production.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.when(
        c.isNull(), F.lit(None).cast("string")
    ).otherwise(
        F.concat(F.sha2(F.concat(F.lit(f"{secret}:"), F.substring_index(c, "@", 1)), 256),
                 F.lit("@"), F.substring_index(c, "@", -1))
    )


def mask_phone(col: Column | str = "phone") -> Column:
    """Replace every digit but the last four by ``X``; NULL stays NULL."""
    c = F.col(col) if isinstance(col, str) else col
    head = c.substr(F.lit(1), F.greatest(F.length(c) - 4, F.lit(0)))
    tail = c.substr(F.greatest(F.length(c) - 3, F.lit(1)), F.lit(4))
    return F.concat(F.regexp_replace(head, "[0-9]", "X"), tail)


def pack_digits(col: Column | str) -> tuple[Column, Column]:
    """A text for the way through a shuffle as ``(packed, rest)``: digits and dashes take four bits each; a text with
    anything else is left whole in ``rest``, which is NULL otherwise.  ``unpack_digits`` gives the text back."""
    c = F.col(col) if isinstance(col, str) else col
    even = F.concat(c, F.when(F.octet_length(c) % 2 == 1, "F").otherwise(""))
    packed = F.unhex(F.replace(even, F.lit("-"), F.lit("A")))  # NULL for other characters
    kept = F.coalesce(unpack_digits(packed, F.lit(None).cast("string")) == c, F.lit(False))
    return F.when(kept, packed), F.when(~kept, c)


def unpack_digits(packed: Column | str, rest: Column | str) -> Column:
    p, r = (F.col(x) if isinstance(x, str) else x for x in (packed, rest))
    digits = F.replace(F.replace(F.hex(p), F.lit("A"), F.lit("-")), F.lit("F"), F.lit(""))
    return F.coalesce(r, digits)


def pack_columns(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """``df`` with each of these texts packed, as ``_<name>`` and ``_<name>_rest``, in its place."""
    out = []
    for name in df.columns:
        if name in columns:
            packed, rest = pack_digits(name)
            out += [packed.alias(f"_{name}"), rest.alias(f"_{name}_rest")]
        else:
            out.append(F.col(name))
    return df.select(*out)


def unpack_columns(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return df.withColumns({c: unpack_digits(f"_{c}", f"_{c}_rest") for c in columns}) if columns else df
