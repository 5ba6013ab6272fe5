"""Apply a change log to a keyed table.

Every mode is one aggregate per key over the changes, so a key that holds a third of all rows is reduced on the map side
before anything is shuffled. The reduced changes then meet the target once per key.

``fold`` reduces changes to one row per key; ``merge`` combines that with a target; ``apply_changes`` does both.
"""

from __future__ import annotations

from functools import reduce
from typing import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ..spec import OP

KIND = "_kind"
_HIT, GONE, ALIVE = "_hit", "_gone", "_alive"
SALT = 8


def to_op(df: DataFrame, kind: str = KIND) -> DataFrame:
    """Row kind to load operation: inserts and after-images 0, deletes and before-images 1, anything else is an error."""
    k = F.col(kind)
    op = (
        F.when(k.isin("+I", "+U"), 0)
        .when(k.isin("-D", "-U"), 1)
        .otherwise(F.raise_error(F.concat(F.lit("unknown row kind "), F.coalesce(k, F.lit("null")))).cast("int"))
    )
    return df.withColumn(OP, op)


def filter_kinds(df: DataFrame, has_pk: bool, ignore_update_before: bool = True, kind: str = KIND) -> DataFrame:
    """Drop the row kinds a target cannot take."""
    dropped = (["-U"] if not has_pk or ignore_update_before else []) + ([] if has_pk else ["-D"])
    return df.where(~F.col(kind).isin(dropped)) if dropped else df


def expand_updates(
    df: DataFrame, before: str, after: str, op: Column, ignore_update_before: bool = True,
    read: Callable[[Column], Column] = lambda image: image,
) -> DataFrame:
    """Turn change events with before/after images into load rows.

    ``op`` is the event letter: r, c, u carry ``after``, d carries ``before``. With ``ignore_update_before=False`` an
    update gives two rows, the delete of the before image first, so an update that moves a row to another key removes
    the old key. Adds ``_row`` (the image, passed through ``read``), ``__op`` and ``_sub`` (order inside one event).
    """
    row = lambda image, code, sub: F.struct(read(F.col(image)).alias("_row"), F.lit(code).alias(OP), F.lit(sub).alias("_sub"))
    upsert, delete = F.array(row(after, 0, 1)), F.array(row(before, 1, 0))
    if ignore_update_before:
        rows = F.when(op == "d", delete).when(op.isin("r", "c", "u"), upsert)
    else:
        both = F.when(F.col(before).isNotNull(), F.concat(delete, upsert)).otherwise(upsert)
        rows = F.when(op == "d", delete).when(op == "u", both).when(op.isin("r", "c"), upsert)
    return df.withColumn("_image", F.explode(rows)).select("*", "_image.*").drop("_image")


def _order(keys: list[str], seq: list[str]) -> Column:
    """Total order of the changes. Deletes precede upserts of the same position. A null key is an error."""
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    parts = [F.col(s).alias(f"s{i}") for i, s in enumerate(seq)]
    turn = F.when(null_key, F.raise_error(F.lit("null in a primary key column")).cast("int")).otherwise(1 - F.col(OP))
    return F.struct(*parts, turn.alias("turn"))


def _value(column: str) -> str:
    return f"_n_{column}"


def _set(column: str) -> str:
    return f"_s_{column}"


def fold(
    changes: DataFrame,
    keys: Iterable[str],
    seq: Iterable[str],
    columns: Iterable[str],
    mode: str = "full",
    merge_condition: str | None = None,
    present: Mapping[str, Column] | None = None,
    salt: int = SALT,
) -> DataFrame:
    """Reduce load rows (``keys``, ``columns``, ``seq``, ``__op``) to one row per key.

    Result: keys, ``_gone`` (the target row no longer counts), ``_alive`` (the key exists afterwards), ``_n_<column>``
    and, for partial mode, ``_s_<column>`` (the column was supplied).
    ``present`` gives, per column, whether a row supplies it; a column without entry is supplied by every row.
    """
    keys, seq, columns = list(keys), list(seq), list(columns)
    if mode == "conditional":
        return _fold_conditional(changes, keys, seq, columns, merge_condition, salt)
    rows = changes.withColumn("_ord", _order(keys, seq))
    if mode == "full":
        last = rows.groupBy(*keys).agg(F.max_by(F.struct(OP, *columns), "_ord").alias("_w"))
        alive = F.col(f"_w.{OP}") == 0
        values = [F.col(f"_w.{c}").alias(_value(c)) for c in columns]
        return last.select(*keys, F.lit(True).alias(GONE), alive.alias(ALIVE), *values)
    if mode != "partial":
        raise ValueError(f"unknown mode {mode}")
    return _fold_partial(rows, keys, columns, dict(present or {}))


def _fold_partial(rows: DataFrame, keys: list[str], columns: list[str], present: dict[str, Column]) -> DataFrame:
    """Per column the last supplied value, kept only if it is later than the key's last delete.

    A value that lost against a later delete is recognised by its own position, so no second pass is needed.
    """
    upsert = F.col(OP) == 0
    always = [c for c in columns if c not in present]
    groups = [(None, always)] + [(present[c], [c]) for c in columns if c in present]
    aggs = [
        F.max(F.when(~upsert, F.col("_ord"))).alias("_del"),
        F.max(F.when(upsert, F.col("_ord"))).alias("_up"),
    ]
    source: dict[str, str] = {}
    for i, (flag, names) in enumerate(groups):
        if not names:
            continue
        taken = upsert if flag is None else upsert & F.coalesce(flag, F.lit(False))
        packed = F.struct(F.col("_ord").alias("at"), *[F.col(c).alias(f"v{j}") for j, c in enumerate(names)])
        aggs.append(F.max_by(F.when(taken, packed), F.when(taken, F.col("_ord"))).alias(f"_g{i}"))
        source.update({c: f"_g{i}.v{j}" for j, c in enumerate(names)})
    folded = rows.groupBy(*keys).agg(*aggs)
    since = lambda at: at.isNotNull() & (F.col("_del").isNull() | (at > F.col("_del")))
    outs = []
    for c in columns:
        given = since(F.col(source[c].split(".")[0] + ".at"))
        outs += [F.when(given, F.col(source[c])).alias(_value(c)), given.alias(_set(c))]
    return folded.select(
        *keys, F.col("_del").isNotNull().alias(GONE), since(F.col("_up")).alias(ALIVE), *outs
    )


def _fold_conditional(
    changes: DataFrame, keys: list[str], seq: list[str], columns: list[str], condition: str | None, salt: int
) -> DataFrame:
    """Among the upserts after the key's last delete, the row with the highest condition value; ties go to the later row.

    The last delete per key is joined back on (key, salt): the rows of a hot key spread over ``salt`` tasks, AQE may
    split those further or broadcast the deletes when they are small, and the aggregate that follows combines map-side.
    """
    if condition not in columns:
        raise ValueError("merge_condition must name one of the value columns")
    rows = changes.withColumn("_ord", _order(keys, seq))
    deletes = rows.where(F.col(OP) == 1).groupBy(*keys).agg(F.max("_ord").alias("_del"))
    spread = deletes.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    upserts = rows.where(F.col(OP) == 0).withColumn("_salt", F.pmod(F.xxhash64(*seq), F.lit(salt)).cast("int"))
    live = upserts.join(spread, [*keys, "_salt"], "left").where(
        F.col("_del").isNull() | (F.col("_ord") > F.col("_del"))
    )
    candidates = live.select(
        *keys,
        F.struct(*columns).alias("_row"),
        F.struct(F.col(condition).alias("c"), F.col("_ord").alias("o")).alias("_rank"),
        "_del",
    )
    # the deletes take part themselves, so a key whose last event is a delete is known as well
    both = candidates.unionByName(deletes, allowMissingColumns=True)
    best = both.groupBy(*keys).agg(F.max_by("_row", "_rank").alias("_w"), F.max("_del").alias("_del"))
    return best.select(
        *keys,
        F.col("_del").isNotNull().alias(GONE),
        F.col("_w").isNotNull().alias(ALIVE),
        *[F.col(f"_w.{c}").alias(_value(c)) for c in columns],
    )


def _resolve(
    df: DataFrame, keys: list[str], out: list[str], columns: list[str], mode: str, condition: str | None
) -> DataFrame:
    """Rows where target columns and folded columns sit side by side -> resulting table rows."""
    hit = F.col(_HIT).isNotNull()
    gone = hit & F.col(GONE)
    if mode == "conditional":
        current, new = F.struct(F.col(condition)), F.struct(F.col(_value(condition)).alias(condition))
        keep_target = ~hit | (F.col("_in").isNotNull() & ~gone & F.col(ALIVE) & (new < current))
    else:
        keep_target = ~hit
    result = []
    for c in out:
        if c in keys:
            result.append(F.col(c))
        elif c not in columns:
            # not part of the load: kept on a partial update, null on a new row
            result.append(F.when(gone, F.lit(None)).otherwise(F.col(c)).alias(c))
        elif mode == "partial":
            new = F.when(F.col(_set(c)), F.col(_value(c))).when(~gone, F.col(c))
            result.append(F.when(keep_target, F.col(c)).otherwise(new).alias(c))
        else:
            result.append(F.when(keep_target, F.col(c)).otherwise(F.col(_value(c))).alias(c))
    return df.where(~hit | F.col(ALIVE)).select(*result)


def merge(
    target: DataFrame | None,
    folded: DataFrame,
    keys: Iterable[str],
    out: Iterable[str],
    columns: Iterable[str],
    mode: str = "full",
    merge_condition: str | None = None,
    strategy: str = "outer",
) -> DataFrame:
    """Combine a target with folded changes; ``out`` is the target's column order.

    ``outer``: one full outer join, each side is read once. For folds that are not stored anywhere.
    ``split``: rows whose key is not in the fold pass through an anti join, the rest is rebuilt. For a persisted fold:
    if it is small, Catalyst broadcasts its keys and the target is never shuffled.
    """
    keys, out, columns = list(keys), list(out), list(columns)
    marked = folded.withColumn(_HIT, F.lit(True))
    rest = [c for c in out if c not in keys]
    if target is None:
        types = dict(folded.dtypes)
        blank = [
            F.lit(None).cast(types[_value(c)] if _value(c) in types else "string").alias(c) for c in rest
        ] + [F.lit(None).cast("boolean").alias("_in")]
        return _resolve(marked.select("*", *blank), keys, out, columns, mode, merge_condition)
    there = target.select(*out, F.lit(True).alias("_in"))
    if strategy == "outer":
        return _resolve(there.join(marked, keys, "full_outer"), keys, out, columns, mode, merge_condition)
    changed = folded.select(*keys)
    untouched = target.select(*out).join(changed, keys, "left_anti")
    if mode == "full" and set(rest) <= set(columns):
        rebuilt = folded.where(ALIVE).select(*[F.col(c) if c in keys else F.col(_value(c)).alias(c) for c in out])
    else:
        touched = there.join(changed, keys, "left_semi")
        rebuilt = _resolve(marked.join(touched, keys, "left"), keys, out, columns, mode, merge_condition)
    return untouched.unionByName(rebuilt)


def prepare(changes: DataFrame, model: str = "primary", ignore_update_before: bool = True, kind: str = KIND) -> DataFrame:
    """Give changes an ``__op`` column: from the row kind if there is one, else every row is an upsert."""
    if kind in changes.columns:
        changes = to_op(filter_kinds(changes, model == "primary", ignore_update_before, kind), kind)
    elif OP not in changes.columns:
        changes = changes.withColumn(OP, F.lit(0))
    if model == "unique":
        changes = changes.where(F.col(OP) == 0)
    return changes


def apply_changes(
    target: DataFrame | None,
    changes: DataFrame,
    keys: Iterable[str],
    seq: Iterable[str] | str,
    mode: str = "full",
    columns: Iterable[str] | None = None,
    merge_condition: str | None = None,
    ignore_update_before: bool = True,
    model: str = "primary",
    kind: str = KIND,
    present: Mapping[str, Column] | None = None,
    strategy: str = "outer",
    salt: int = SALT,
) -> DataFrame:
    """Table after the change log.

    ``mode``: ``full`` replaces whole rows (columns the changes lack become null), ``partial`` changes only ``columns``, ``conditional`` (or a
    ``merge_condition``) accepts a row only if its condition value is not below the current one. Columns are matched by
    name. ``seq`` must order the changes totally.
    """
    keys = list(keys)
    seq = [seq] if isinstance(seq, str) else list(seq)
    if merge_condition:
        if mode == "partial":
            raise ValueError("merge_condition cannot be combined with a partial update")
        mode = "conditional"
    rows = prepare(changes, model, ignore_update_before, kind)
    helper = {OP, kind, "_sub"}
    out = list(target.columns) if target is not None else [c for c in rows.columns if c not in helper | (set(seq) - set(columns or ()))]
    given = list(columns) if columns is not None else [c for c in out if c in rows.columns]
    values = [c for c in given if c not in keys]
    if mode != "partial":
        missing = [c for c in out if c not in keys and c not in values]
        if missing and target is not None:
            types = {f.name: f.dataType for f in target.schema.fields}
            rows = rows.select("*", *[F.lit(None).cast(types[c]).alias(c) for c in missing])
            values += missing
    folded = fold(rows, keys, seq, values, mode, merge_condition, present, salt)
    return merge(target, folded, keys, out, values, mode, merge_condition, strategy)


def append(target: DataFrame, df: DataFrame) -> DataFrame:
    """Append to a table without unique keys: columns by name in any order and case, missing ones null."""
    known = {c.lower(): c for c in target.columns}
    extra = [c for c in df.columns if c.lower() not in known]
    if extra:
        raise ValueError(f"table has no column {extra[0]}")
    named = df.select(*[F.col(c).alias(known[c.lower()]) for c in df.columns])
    return target.unionByName(named, allowMissingColumns=True)
