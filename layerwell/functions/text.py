"""Text clean-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# The characters that count as white space, in code-point order.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def trim_white_space(column: Column) -> Column:
    """Strip every kind of white space from both ends.

    Plain ``trim`` strips only blanks; the two-argument form takes a character
    set and, unlike a regular expression, makes one pass without backtracking.
    """
    return F.trim(column, F.lit(WHITE_SPACE))


def normalize_strings(df: DataFrame) -> DataFrame:
    """Trim all string columns; other columns and the column order stay."""
    return df.select(
        *(
            trim_white_space(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        )
    )
