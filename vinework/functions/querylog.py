"""Checks over a column of logged graph-query texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Clause words that make a text a graph query.
CLAUSES = (
    "MATCH", "CREATE", "MERGE", "RETURN", "WITH", "WHERE",
    "DELETE", "SET", "REMOVE", "UNWIND", "OPTIONAL",
)

# Messages of the three checks, in the order they are made.
EMPTY = "Cypher query is empty."
DOLLARS = "Cypher query must not contain '$$' (dollar-quote markers)."
NO_CLAUSE = "Cypher query does not contain any recognised Cypher clause (MATCH, CREATE, MERGE, RETURN, …)."

# Output name when a query returns nothing that can be named.
FALLBACK = "result"


def strip_blank(text: Column) -> Column:
    """Remove blanks, tabs and line breaks at both ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def check_query(text: Column) -> Column:
    """Null for an acceptable query, else the message of the first failure."""
    body = strip_blank(text)
    clause = r"(?i)\b(" + "|".join(CLAUSES) + r")\b"
    return F.when(body == "", EMPTY).when(body.contains("$$"), DOLLARS).when(~body.rlike(clause), NO_CLAUSE)


# An item of a list: everything up to a comma outside of brackets and quotes.
ITEM = r"""(?:[^,()\[\]{}'"]|\((?:[^()]|\((?:[^()]|\([^()]*\))*\))*\)|\[[^\]]*\]|\{[^}]*\}|'[^']*'|"[^"]*")+"""


def return_columns(text: Column) -> Column:
    """Output names of the first RETURN clause.

    An item is named by what follows its AS, else by the last name in it:
    ``expr AS x`` gives ``x``, ``n.name`` gives ``name``, ``n`` gives ``n``.
    Commas inside brackets (three deep for round ones) and quotes belong to
    their item.
    """
    after = F.try_element_at(F.split(text, r"(?i)\breturn\b", 2), F.lit(2))
    clause = F.element_at(F.split(after, r"(?i)\b(?:order\s+by|skip|limit)\b", 2), 1)
    items = F.regexp_extract_all(F.coalesce(clause, F.lit("")), F.lit(ITEM), 0)

    def name(item: Column) -> Column:
        named = F.element_at(F.split(item, r"(?i)\bas\b"), -1)
        return F.try_element_at(F.regexp_extract_all(named, F.lit("[0-9A-Za-z_]+"), 0), F.lit(-1))

    names = F.filter(F.transform(items, name), lambda n: n.isNotNull())
    return F.when(F.size(names) > 0, names).otherwise(F.array(F.lit(FALLBACK)))


def strip_fences(text: Column) -> Column:
    """Drop code-fence lines from a text that starts with one."""
    body = strip_blank(text)
    lines = F.filter(F.split(body, r"\r\n|\n|\r"), lambda line: ~line.startswith("```"))
    return F.when(body.startswith("```"), strip_blank(F.array_join(lines, "\n"))).otherwise(body)
