"""The lake's rules as SQL functions, for queries over the staging view and the tables.

They live as long as the session and are plain SQL expressions, so Spark plans them
like the columns they stand for.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from paperlake.functions.identity import STRIPPED_CHARACTERS
from paperlake.functions.text import DOI_PATTERN, NULL_SPELLINGS


def _literal(text: str) -> str:
    """A SQL string; what is neither printable ASCII nor safe in quotes is written by its number."""
    plain = set(map(chr, range(0x20, 0x7F))) - set("'\\")
    return "'" + "".join(c if c in plain else f"\\u{ord(c):04x}" for c in text) + "'"


_BLANKS = _literal(STRIPPED_CHARACTERS)
_NULLS = ", ".join(map(_literal, NULL_SPELLINGS))


def _normalized(name: str) -> str:
    return f"coalesce(trim(both {_BLANKS} from lower({name})), '')"


SQL_FUNCTIONS = {
    "paper_id(title string, authors string, publication_date string)": (
        "string",
        f"sha2(concat({_normalized('title')}, '||', {_normalized('authors')}, '||', coalesce(publication_date, '')), 256)",
    ),
    "clean_text(value string)": (
        "string",
        f"case when value not in ({_NULLS}) and trim(value) <> '' then trim(value) end",
    ),
    "long_enough(value string, min_chars int)": ("boolean", "length(trim(value)) >= min_chars"),
    "truncated(value string, max_chars int)": ("string", "substring(value, 1, max_chars)"),
    "doi_is_valid(doi string)": ("boolean", f"coalesce(doi rlike {_literal(DOI_PATTERN)}, false)"),
    "embedding_text(title string, abstract string, full_text string)": (
        "string",
        "concat_ws(' ', title, abstract, full_text)",
    ),
}


def register_functions(spark: SparkSession) -> list[str]:
    """Creates the functions in the session, again if they are there; returns their names."""
    for signature, (kind, body) in SQL_FUNCTIONS.items():
        spark.sql(f"create or replace temporary function {signature} returns {kind} return {body}")
    return [signature.split("(")[0] for signature in SQL_FUNCTIONS]
