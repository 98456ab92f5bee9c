"""Words, lines and row identity shared by the text operators.

Every operator reads an id column (whole numbers, may be null or repeated) and a text column (may
be null).  Other columns are carried untouched, whatever their names, inside one struct.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zephyrine.session import scratch_path

#: Characters that separate alphanumeric words: ASCII other than digits and lower-case letters.
NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: ASCII white space.
BLANKS = r"[\x20\x09-\x0D]+"
BLANK_CHARS = " \t\n\x0b\x0c\r"


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def word_array(text: Column) -> Column:
    """Lower-cased alphanumeric words in order; null has none."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), NON_WORD), "")


def blank_word_array(text: Column) -> Column:
    """Words between ASCII white space, letters as they are; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def line_array(text: Column) -> Column:
    """Lines between ``\\n``; null and empty have one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also where a lambda uses it again and again."""
    return F.get(F.transform(F.array(value), body), 0)


def carried(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(row, key_id, key_hash, body): the whole row, what identifies its id and text, the text.

    Rows equal in id and text have equal results in every operator, so results may be joined back
    by this key even if rows repeat.
    """
    body = F.col(f"`{text}`")
    return docs.select(
        F.struct("*").alias("row"),
        F.col(f"`{id}`").cast("long").alias("key_id"),
        F.xxhash64(body).alias("key_hash"),
        body.alias("body"),
    )


def same_key(left: DataFrame, right: DataFrame) -> Column:
    """Join condition on the row key; a null id equals a null id."""
    return left["key_id"].eqNullSafe(right["key_id"]) & (left["key_hash"] == right["key_hash"])


def replace_text(text_name: str, value: Column) -> Column:
    """The carried row with another text; ``n_chars`` follows where the row has it."""
    return F.col("row").withField(f"`{text_name}`", value)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table, so that Spark knows its size when it plans a join with it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
