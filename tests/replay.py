"""Change-log replay over a plain dict, row by row: the meaning the Spark folds are tested against."""

import random

COLS = ("a", "b")


def replay(table, log, mode="full", columns=COLS, condition=None, ignore_update_before=True):
    """``log`` rows: dict with k, a, b, kind, and ``has`` (columns the row supplies)."""
    state = {k: dict(v) for k, v in table.items()}
    rank = lambda v: (v is not None, v if v is not None else 0)
    for row in log:
        k, kind = row["k"], row["kind"]
        if kind == "-U" and ignore_update_before:
            continue
        if kind in ("-D", "-U"):
            state.pop(k, None)
            continue
        old = state.get(k)
        if mode == "conditional" and old is not None and rank(row[condition]) < rank(old[condition]):
            continue
        if mode == "partial":
            new = dict(old) if old else {c: None for c in COLS}
            new.update({c: row[c] for c in columns if c in row["has"]})
        else:
            new = {c: row[c] for c in COLS}
        state[k] = new
    return state


def random_log(rng: random.Random, n=60, keys=12, hot=0.33):
    log = []
    for _ in range(n):
        k = 0 if rng.random() < hot else rng.randrange(keys)
        log.append(
            {
                "k": k,
                "a": rng.choice([None, *range(6)]),
                "b": rng.choice([None, "x", "y", "z"]),
                "kind": rng.choices(["+I", "+U", "-D", "-U"], [4, 4, 2, 1])[0],
                "has": {c for c in COLS if rng.random() < 0.6},
            }
        )
    return log
