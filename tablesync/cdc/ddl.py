"""Column additions and removals found in a change feed."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Row, functions as F

from ..spec import ColumnSpec
from ..types import STRING_SIZE, source_type, spark_type, split_type

# fixed values: quoted texts and names, what stands between the commas of a list (parentheses may be nested twice), comments
_QUOTED = r"""'(?:[^'\\]|\\.|'')*+'|"(?:[^"\\]|\\.|"")*+"|`[^`]*+`"""
_INSIDE = rf"\((?:{_QUOTED}|[^()'\"`]|\((?:{_QUOTED}|[^()'\"`]|\((?:{_QUOTED}|[^()'\"`])*+\))*+\))*+\)"
ITEM = rf"(?s)(?:{_QUOTED}|{_INSIDE}|[^,'\"`(])++"
_TOKEN = rf"(?s){_QUOTED}|/\*.*?\*/|--[^\n]*|#[^\n]*|[^'\"`/#-]++|."
_COMMENT = r"(?s)\A(?:/\*.*|--.*|#.*)"
_NAME = r"(?:`[^`]+`|\"[^\"]+\"|[^\s`\",.;()]+)"
# fixed values: the statement (name, then its clauses), one clause (action, column, type), a list of columns in parentheses, and
# words after ADD/DROP that name no column
STATEMENT = rf"(?is)\A\s*ALTER\s+TABLE\s+(?:IF\s+EXISTS\s+)?{_NAME}(?:\s*\.\s*{_NAME})*\s+(.*?)\s*;?\s*\z"
CLAUSE = rf"(?is)\A\s*(ADD|DROP)\s+(?:COLUMN\s+)?(?:IF\s+(?:NOT\s+)?EXISTS\s+)?({_NAME})(?:\s+([A-Za-z]+(?:\s*\((?:'[^']*'|[^')])*\))?(?:\s+UNSIGNED)?))?"
LISTED = r"(?is)\A\s*ADD\s+(?:COLUMN\s+)?\((.*)\)\s*\z"
NOT_COLUMNS = ("INDEX", "KEY", "CONSTRAINT", "PRIMARY", "UNIQUE", "FOREIGN", "PARTITION", "FULLTEXT", "SPATIAL", "CHECK")


def parse_ddl(events: DataFrame, enabled: bool = True, table: str | None = None) -> DataFrame:
    """DDL events of parsed change events: no ``op``, a statement in the history record.

    Empty unless schema evolution is ``enabled``. ``table`` (``db.table``) keeps the statements of one source table.
    """
    ddl = events.where(F.col("op").isNull() & F.col("ddl").isNotNull())
    if table is not None:
        ddl = ddl.where(F.concat_ws(".", "src_db", "src_table") == table)
    return ddl if enabled else ddl.where(F.lit(False))


def ddl_to_actions(ddl: DataFrame, col: str = "ddl", pattern: str = STATEMENT, clause: str = CLAUSE) -> DataFrame:
    """Statements to column actions ``action`` (add/drop), ``column``, ``type`` (null for a drop), one row per clause.

    ``clause_no`` numbers the clauses of a statement. Comments are left out, but not from quoted texts (of DEFAULT, COMMENT), whose
    commas and parentheses separate nothing either; names may be quoted and hold blanks; ADD may list
    columns in parentheses; FIRST and AFTER change nothing. Clauses of another kind give no row. Patterns of one's own need the
    same groups.
    """
    tokens = F.regexp_extract_all(F.col(col), F.lit(_TOKEN), F.lit(0))
    body = F.regexp_extract(F.array_join(F.transform(tokens, lambda t: F.when(t.rlike(_COMMENT), " ").otherwise(t)), ""), pattern, 1)
    items = lambda text: F.regexp_extract_all(text, F.lit(ITEM), F.lit(0))
    listed = lambda text: F.regexp_extract(text, LISTED, 1)
    added = lambda text: F.transform(items(listed(text)), lambda x: F.concat(F.lit("ADD "), F.ltrim(x)))
    parts = F.flatten(F.transform(items(body), lambda c: F.when(listed(c) != "", added(c)).otherwise(F.array(c))))
    rows = ddl.select("*", F.posexplode(parts).alias("clause_no", "_clause"))
    part = lambda i: F.regexp_extract("_clause", clause, i)
    action, name = F.lower(part(1)), F.regexp_replace(part(2), "[`\"]", "")
    rows = rows.withColumns({"action": action, "column": name, "type": F.when(action == "add", added_type(part(3)))})
    quoted = F.col("_clause").rlike(r"(?is)\A\s*\w+\s+(?:COLUMN\s+)?[`\"]")
    return rows.where((F.col("action") != "") & (quoted | ~F.upper("column").isin(*NOT_COLUMNS))).drop("_clause")


def added_type(text: Column) -> Column:
    """Type of an added column: ``VARCHAR(n)`` becomes ``varchar(min(3n, 65533))``, other types stay."""
    length = F.regexp_extract(text, r"(?i)^varchar\s*\(\s*([1-9][0-9]*)\s*\)$", 1)
    wide = F.format_string("varchar(%d)", F.least(F.nullif(length, F.lit("")).cast("bigint") * 3, F.lit(STRING_SIZE)))
    return F.when(length != "", wide).otherwise(text)


def column_of(action: Row) -> ColumnSpec | None:
    """Column an ``add`` action creates; None if its type is unknown (the action is then skipped)."""
    text = re.sub(r"\s+", " ", action["type"] or "").strip() or "STRING"
    unsigned = text.upper().endswith(" UNSIGNED")
    text = re.sub(r"\s+", "", text[: -len(" UNSIGNED")] if unsigned else text)
    if text.upper().startswith(("ENUM(", "SET(")):
        text = "STRING"
    name, size, scale = split_type(text)
    if unsigned:
        name = f"{name} UNSIGNED"
    try:
        mapped = text if name in ("VARCHAR", "CHAR") and size else source_type(name, size, scale)
    except ValueError:
        mapped = text.upper()
    try:
        spark_type(mapped)
    except Exception:
        return None
    return ColumnSpec(action["column"], mapped.upper() if "<" not in mapped else mapped)


def last_actions(actions: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Last action per table and column: at most one row per column ever named, whatever the number of statements.

    ``n_add``/``n_drop`` tell whether a column was created or removed on the way; ``_at`` is the position of the last
    action, ``_first_add`` orders new columns.
    """
    at = F.struct(*order, *(["clause_no"] if "clause_no" in actions.columns else []))
    return actions.groupBy(*by, "column").agg(
        F.max_by(F.struct("action", "type"), at).alias("_last"),
        F.max(at).alias("_at"),
        F.min(F.when(F.col("action") == "add", at)).alias("_first_add"),
        F.count_if(F.col("action") == "drop").alias("n_drop"),
    ).select(*by, "column", "_last.*", "_at", "_first_add", "n_drop")
