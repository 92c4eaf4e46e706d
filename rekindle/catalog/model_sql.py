"""SQL of the closed-form part of training: split, dictionary, vectors and a Gaussian Bayes model.

It recomputes from the feature table what fitted, stored and reloaded models say about each row.
"""

from __future__ import annotations

from collections.abc import Sequence

SPLITS = """splits AS (SELECT *, CASE WHEN place < 0.6::DOUBLE THEN 'train'
WHEN place < 0.8::DOUBLE THEN 'validation' ELSE 'test' END AS split FROM (
SELECT *, (ROW_NUMBER() OVER (PARTITION BY will_reactivate
ORDER BY substr(md5(CAST(user_id AS VARCHAR)), 1, 8), user_id) - 1)::DOUBLE
/ COUNT(*) OVER (PARTITION BY will_reactivate) AS place FROM features))"""


def vectors(name: str, fit: str, numeric: Sequence[str], flags: Sequence[str], categorical: Sequence[str]) -> str:
    """``<name>_x(user_id, position, x)``: vectors of all users, prepared on the rows ``fit`` selects."""
    own = f"(SELECT * FROM splits WHERE {fit})"
    plain = [f"COALESCE(CAST({c} AS DOUBLE), (SELECT AVG({c}) FROM {own}))" for c in numeric]
    plain += [f"COALESCE(CAST({c} AS DOUBLE), 0)" for c in flags]
    first = len(plain)
    numbers = f"SELECT user_id, unnest(range(0, {first})) AS position, unnest([{', '.join(plain)}]::DOUBLE[]) AS x FROM splits"
    if not categorical:
        return f"{name}_x AS ({numbers})"
    names = ", ".join(f"'{c}'" for c in categorical)
    order = ", ".join(f"({k}, '{c}')" for k, c in enumerate(categorical))
    return f"""{name}_cats AS (SELECT user_id, {fit} AS fit, unnest([{names}]) AS c, unnest([{', '.join(categorical)}]) AS v FROM splits),
{name}_dict AS (SELECT c, v, ROW_NUMBER() OVER (PARTITION BY c ORDER BY n DESC, v) - 1 AS place
  FROM (SELECT c, v, COUNT(*) AS n FROM {name}_cats WHERE fit AND v IS NOT NULL GROUP BY ALL)),
{name}_sizes AS (SELECT c, k, {first} + COALESCE(SUM(k + 1) OVER (ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first
  FROM (SELECT o, o.c, COUNT(d.c) AS k FROM (VALUES {order}) o(o, c) LEFT JOIN {name}_dict d USING (c) GROUP BY ALL)),
{name}_x AS ({numbers} UNION ALL
SELECT user_id, first + i AS position, CASE WHEN i = COALESCE(place, k) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS x
FROM (SELECT user_id, place, k, first, unnest(range(0, k + 1)) AS i
  FROM {name}_cats LEFT JOIN {name}_dict USING (c, v) JOIN {name}_sizes USING (c)))"""


def gaussian(name: str) -> str:
    """``<name>_p(user_id, probability)`` of the model fitted on the training rows of ``<name>_x``."""
    return f"""{name}_stats AS (SELECT will_reactivate AS y, position, COUNT(*) AS k, AVG(x) AS m, AVG(x * x) AS q
  FROM {name}_x JOIN splits USING (user_id) WHERE split = 'train' GROUP BY ALL),
{name}_least AS (SELECT MAX(v) * 1e-9 AS e FROM (SELECT SUM(k * q) / SUM(k) - POWER(SUM(k * m) / SUM(k), 2) AS v
  FROM {name}_stats GROUP BY position)),
{name}_law AS (SELECT y, position, m, q - m * m + e AS s, ln(k::DOUBLE / SUM(k) OVER (PARTITION BY position)) AS prior
  FROM {name}_stats, {name}_least),
{name}_joint AS (SELECT user_id, y, MAX(prior) - SUM(POWER(x - m, 2) / s + ln(s)) / 2 AS j
  FROM {name}_x JOIN {name}_law USING (position) GROUP BY ALL),
{name}_p AS (SELECT user_id, 1.0::DOUBLE / (1.0::DOUBLE + exp(LEAST(700.0::DOUBLE,
  SUM(j) FILTER (y = 0) - SUM(j) FILTER (y = 1)))) AS probability FROM {name}_joint GROUP BY user_id)"""


def counts(of: str, keys: str) -> str:
    """Confusion counts and log-loss of rows ``(keys, label, probability)``."""
    return f"""SELECT {keys}, COUNT(*) AS n,
COUNT(*) FILTER (probability >= 0.5 AND label = 1) AS tp, COUNT(*) FILTER (probability >= 0.5 AND label = 0) AS fp,
COUNT(*) FILTER (probability < 0.5 AND label = 1) AS fn, COUNT(*) FILTER (probability < 0.5 AND label = 0) AS tn,
AVG(-ln(GREATEST(1e-15, LEAST(1 - 1e-15, CASE WHEN label = 1 THEN probability ELSE 1 - probability END)))) AS log_loss
FROM {of} GROUP BY {keys}"""
