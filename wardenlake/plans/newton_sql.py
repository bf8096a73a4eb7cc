"""The balanced regression in SQL, for the twins of queries that fit it: Newton steps as a recursive table.

A step sums gradient and Hessian of every fit over its training rows; nested selects eliminate one unknown each, so the
last of them has the step. Four features and a one, as the test tables have; `events` has no gaps to fill.
"""

from __future__ import annotations

STEPS = 30
PENALTY = "1.0::DOUBLE"
SIZE = 5  # Time, Amount, V1, V2 and the intercept


def _columns(form: str, own: range = range(SIZE)) -> str:
    return ", ".join(form.format(i=i) for i in own)


def _margin(row: str, beta: str) -> str:
    return " + ".join(f"{row}.x{i} * {beta}.b{i}" for i in range(SIZE))


def _sums() -> str:
    """Gradient and Hessian of the penalised loss at the latest coefficients, a row per fit."""
    cells = []
    for i in range(SIZE):
        ridge = i < SIZE - 1
        cells.append(f"sum(w * (p - Class) * x{i}){f' + {PENALTY} * any_value(b{i})' if ridge else ''} AS g{i}")
        cells += [f"sum(w * p * (1.0::DOUBLE - p) * x{i} * x{j}){f' + {PENALTY}' if ridge and i == j else ''} AS a{i}{j}" for j in range(SIZE)]
    rows = f"""SELECT z.*, beta.step, {_columns('beta.b{i}')}, 1.0::DOUBLE / (1.0::DOUBLE + exp(-({_margin('z', 'beta')}))) AS p
      FROM beta JOIN z ON z.held = beta.held WHERE z.part = 'train' AND beta.step < {STEPS}"""
    return f"SELECT held, step, {_columns('any_value(b{i}) AS b{i}')}, {', '.join(cells)} FROM ({rows}) GROUP BY held, step"


def _eliminated(table: str, k: int) -> str:
    """The system without unknown k: its row divided by the pivot, a multiple of it taken from all others."""
    cells = [f"g{i} - a{i}{k} * g{k} / a{k}{k} AS g{i}" if i != k else f"g{k} / a{k}{k} AS g{k}" for i in range(SIZE)]
    for j in range(k + 1, SIZE):
        cells += [f"a{i}{j} - a{i}{k} * a{k}{j} / a{k}{k} AS a{i}{j}" if i != k else f"a{k}{j} / a{k}{k} AS a{k}{j}" for i in range(SIZE)]
    return f"SELECT held, step, {_columns('b{i}')}, {', '.join(cells)} FROM ({table})"


def fitted_scores(given: str) -> str:
    """CTEs up to `fitted` (held, tx_id, Class, score, prediction) of all test rows.

    given: a table with held (the number of the fit), part ('train' or 'test'), tx_id, Class and the features.
    """
    solved = _sums()
    for k in range(SIZE):
        solved = _eliminated(solved, k)
    return f"""caps AS (SELECT held, quantile_cont(Amount, 0.999) AS cap FROM {given} WHERE part = 'train' GROUP BY held),
 capped AS (SELECT g.held, part, tx_id, Class, Time, V1, V2, least(Amount, cap) AS Amount FROM {given} g JOIN caps ON caps.held = g.held),
 moments AS (SELECT held, avg(Time) AS mt, stddev_pop(Time) AS st, avg(Amount) AS ma, stddev_pop(Amount) AS sa,
   count(*)::DOUBLE AS n, sum(Class)::DOUBLE AS n1 FROM capped WHERE part = 'train' GROUP BY held),
 z AS MATERIALIZED (SELECT c.held, part, tx_id, Class, (Time - mt) / st AS x0, (Amount - ma) / sa AS x1, V1 AS x2, V2 AS x3, 1.0::DOUBLE AS x4,
   n / (2.0::DOUBLE * CASE WHEN Class = 1 THEN n1 ELSE n - n1 END) AS w FROM capped c JOIN moments m ON m.held = c.held),
 beta AS (SELECT held, 0 AS step, {_columns('0.0::DOUBLE AS b{i}')} FROM moments
   UNION ALL SELECT held, step + 1, {_columns('b{i} - g{i}')} FROM ({solved})),
 fitted AS (SELECT *, CASE WHEN score > 0.5::DOUBLE THEN 1 ELSE 0 END AS prediction FROM (
   SELECT z.held, z.tx_id, z.Class, 1.0::DOUBLE / (1.0::DOUBLE + exp(-({_margin('z', 'b')}))) AS score
   FROM z JOIN beta b ON b.held = z.held WHERE z.part = 'test' AND b.step = {STEPS}))"""
