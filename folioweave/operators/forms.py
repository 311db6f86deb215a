"""Where a form's types and stats come from, decided by counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def resolve_forms(n_types: Column, n_forms: Column, n_stats: Column, i: Column,
                  special: Column | None = None, gen: int = 4) -> tuple[Column, Column]:
    """(type mode, 0-based stat table) for form ``i``; the first fitting case decides.

    ``n_types`` counts type rows, ``n_stats`` stat tables, ``special`` special forms. Type
    modes: ``map`` looks the form up by name, ``index`` takes the i-th type row, ``shared``
    uses the page's one type list.
    """
    named = "index" if gen < 5 else "map"
    first_or_second = F.when(i == 0, F.lit(0)).otherwise(F.lit(1))
    all_equal = (n_types == n_forms) & (n_forms == n_stats)
    one_table = (n_types == n_forms) & (n_stats == 1) & F.lit(gen >= 7)
    no_types = n_types == 0
    uneven = (n_types != n_forms) & (n_forms == n_stats)

    cases: list[tuple[Column, str, Column]] = []
    if special is not None:
        cases.append((special > 0, "map", i))
    cases += [
        (all_equal, named, i),
        (one_table, "map", F.lit(0)),
        (no_types & (n_forms == n_stats), "shared", i),
        (no_types, "shared", first_or_second),
        (uneven, "index" if gen < 5 else "shared", first_or_second),
    ]
    mode = stat = None
    for cond, m, s in cases:
        mode = F.when(cond, F.lit(m)) if mode is None else mode.when(cond, F.lit(m))
        stat = F.when(cond, s) if stat is None else stat.when(cond, s)
    return mode.otherwise(F.lit(named)), stat.otherwise(first_or_second)
