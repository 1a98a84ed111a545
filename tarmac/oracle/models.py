"""Model inputs and closed-form fits as DuckDB SQL.

A regression on one-hot airports and a common time slope is the regression on values centred within
each airport, so its predictions have a closed form. The same holds for a slope per airport with a
common square term, after taking each airport's own line out of both sides.
"""

from __future__ import annotations

from tarmac.oracle.eda import STATS, with_flights
from tarmac.oracle.views import half_up, pct

SQL: dict[str, str] = {}

SQL["ml_time_split"] = """SELECT CASE WHEN flight_date < DATE '2015-01-23' THEN 'train' ELSE 'test' END AS part,
  carrier AS airline, count(*) AS flights, min(flight_date) AS first_date, max(flight_date) AS last_date,
  avg(delay) AS mean_delay FROM analysed WHERE flight_date <> DATE '2015-01-23' GROUP BY 1, 2"""

_BY_TIME = f"SELECT carrier AS airline, origin, departure_seconds, {STATS} FROM analysed GROUP BY 1, 2, 3"
_TRIMMED = f"""SELECT carrier AS airline, origin, departure_seconds, {STATS} FROM analysed
  WHERE delay < 60 GROUP BY 1, 2, 3"""
SQL["ml_mean_delay_by_time"] = _BY_TIME
SQL["ml_merged_delays"] = f"SELECT airline, origin AS airport_id, departure_seconds, mean FROM ({_TRIMMED})"


def _line(source: str, prefix: str = "") -> str:
    hours = "departure_seconds / 3600.0::DOUBLE"
    slope = f"CASE WHEN count(*) > 1 THEN regr_slope(mean, {hours}) ELSE 0.0 END"
    intercept = f"CASE WHEN count(*) > 1 THEN regr_intercept(mean, {hours}) ELSE avg(mean) END"
    return f"""SELECT airline, origin, count(*) AS {prefix}points, {slope} AS {prefix}slope,
  {intercept} AS {prefix}intercept FROM ({source}) GROUP BY 1, 2"""


def _rounded(*columns: str) -> str:
    return ", ".join(f"{half_up(c, 6)} AS {c}" for c in columns)


SQL["ml_linear_fit"] = f"SELECT * REPLACE ({_rounded('slope', 'intercept')}) FROM ({_line(_BY_TIME)})"
_AT_NOON = "(all_intercept + all_slope * 12) - (trimmed_intercept + trimmed_slope * 12)"
SQL["ml_outlier_effect"] = f"""SELECT * REPLACE (
    {_rounded("all_slope", "all_intercept", "trimmed_slope", "trimmed_intercept")}),
  {half_up(_AT_NOON, 4)} AS noon_difference
  FROM ({_line(_BY_TIME, "all_")}) JOIN ({_line(_TRIMMED, "trimmed_")}) USING (airline, origin)"""

# Square, line or constant, whichever the number of points allows.
_DET = "(sxx * szz - sxz * sxz)"
_B = f"(CASE WHEN n > 2 THEN (szz * sxy - sxz * szy) / {_DET} WHEN n = 2 THEN sxy / sxx ELSE 0.0 END)"
_C = f"(CASE WHEN n > 2 THEN (sxx * szy - sxz * sxy) / {_DET} ELSE 0.0 END)"
SQL["ml_poly_fit"] = f"""SELECT airline, origin, n AS train_points, {half_up(f"my - {_B} * mx - {_C} * mz", 3)} AS c0,
  {half_up(_B, 3)} AS c1, {half_up(_C, 3)} AS c2, {half_up(f"greatest(syy - {_B} * sxy - {_C} * szy, 0.0)", 3)} AS mse
FROM (SELECT airline, origin, count(*) AS n, avg(y) AS my, avg(x) AS mx, avg(z) AS mz, var_pop(x) AS sxx,
    var_pop(z) AS szz, var_pop(y) AS syy, covar_pop(x, z) AS sxz, covar_pop(x, y) AS sxy, covar_pop(z, y) AS szy
  FROM (SELECT airline, origin, mean AS y, departure_seconds / 86400.0::DOUBLE AS x,
      power(departure_seconds / 86400.0::DOUBLE, 2) AS z FROM ({_TRIMMED})) GROUP BY 1, 2)"""

_AA = f"SELECT origin AS airport_id, departure_seconds, mean FROM ({_TRIMMED}) WHERE airline = 'AA'"
SQL["ml_airport_index"] = f"""SELECT airport_id, CAST(dense_rank() OVER (ORDER BY airport_id) - 1 AS INT)
  AS airport_index FROM (SELECT DISTINCT airport_id FROM ({_AA}))"""
SQL["ml_one_hot"] = f"""SELECT airport_id, departure_seconds, mean,
  CAST(dense_rank() OVER (ORDER BY airport_id) - 1 AS INT) AS airport_index,
  CAST((SELECT count(DISTINCT airport_id) + 1 FROM ({_AA})) AS INT) AS feature_count,
  CAST(dense_rank() OVER (ORDER BY airport_id) - 1 AS INT) AS active_position FROM ({_AA})"""

_T = "departure_seconds / 86400.0::DOUBLE"
_CENTRED = f"""SELECT *, mean - avg(mean) OVER g AS yc, t - avg(t) OVER g AS tc, avg(mean) OVER g AS ym
  FROM (SELECT *, {_T} AS t FROM ({_AA})) WINDOW g AS (PARTITION BY airport_id)"""
_OLS = f"""SELECT airport_id, departure_seconds, mean,
  ym + (SELECT sum(tc * yc) / sum(tc * tc) FROM ({_CENTRED})) * tc AS prediction FROM ({_CENTRED})"""
_OWN_LINE = f"""SELECT p.*, mean - ym - sy * (t - tm) AS ry, t * t - zm - sz * (t - tm) AS rz, ym + sy * (t - tm) AS own
  FROM (SELECT *, {_T} AS t FROM ({_AA})) p JOIN (SELECT airport_id, avg(mean) AS ym, avg(t) AS tm, avg(t * t) AS zm,
      CASE WHEN count(*) > 1 THEN regr_slope(mean, t) ELSE 0 END AS sy,
      CASE WHEN count(*) > 1 THEN regr_slope(t * t, t) ELSE 0 END AS sz
    FROM (SELECT *, {_T} AS t FROM ({_AA})) GROUP BY airport_id) USING (airport_id)"""
_POLY = f"""SELECT airport_id, departure_seconds, mean,
  own + (SELECT sum(ry * rz) / sum(rz * rz) FROM ({_OWN_LINE})) * rz AS prediction FROM ({_OWN_LINE})"""



def _parts(source: str, *identity: str) -> str:
    """Rows with their part of the 70/30 hash split."""
    text = "concat_ws('|', '0', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in identity) + ")"
    bucket = f"CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT) % 10"
    return f"SELECT *, CASE WHEN {bucket} < 7 THEN 'train' ELSE 'test' END AS part FROM ({source})"


# One line per airport and a common square term, fitted on the training part, applied to all rows.
_SPLIT = f"""
SELECT p.*, ym + sy * (t - tm) + (SELECT sum((mean - ym - sy * (t - tm)) * (t * t - zm - sz * (t - tm)))
    / sum((t * t - zm - sz * (t - tm)) * (t * t - zm - sz * (t - tm)))
  FROM parted JOIN lines USING (airport_id) WHERE part = 'train') * (t * t - zm - sz * (t - tm)) AS prediction
FROM parted p JOIN lines USING (airport_id)"""
_SPLIT_SCOPE = f"""WITH parted AS (SELECT *, {_T} AS t FROM ({_parts(_AA, "airport_id", "departure_seconds")})),
lines AS (SELECT airport_id, avg(mean) AS ym, avg(t) AS tm, avg(t * t) AS zm,
    CASE WHEN count(*) > 1 THEN regr_slope(mean, t) ELSE 0 END AS sy,
    CASE WHEN count(*) > 1 THEN regr_slope(t * t, t) ELSE 0 END AS sz
  FROM parted WHERE part = 'train' GROUP BY airport_id)"""
_ERROR = "(prediction - mean) * (prediction - mean)"
SQL["ml_split_eval"] = f"""SELECT * FROM ({_SPLIT_SCOPE}
SELECT part, count(*) AS points, {half_up(f"avg({_ERROR})", 4)} AS mse,
  {half_up(f"sqrt(avg({_ERROR}))", 4)} AS rmse_minutes FROM ({_SPLIT}) GROUP BY part)"""
SQL["ml_residual_terms"] = f"""SELECT * FROM ({_SPLIT_SCOPE}
SELECT airport_id, departure_seconds, {half_up(_ERROR, 4)} AS squared_error,
  {half_up("prediction", 4)} AS prediction, mean
FROM ({_SPLIT}) WHERE part = 'test' AND {_ERROR} > 400)"""

_BEFORE, _AFTER = (
    f"""SELECT carrier AS airline, origin, avg(delay) AS y, departure_seconds / 86400.0::DOUBLE AS x,
  power(departure_seconds / 86400.0::DOUBLE, 2) AS z FROM analysed
  WHERE delay < 60 AND flight_date {side} DATE '2015-10-01' GROUP BY carrier, origin, departure_seconds"""
    for side in ("<", ">")
)
_HOLDOUT_ERROR = f"power(my + {_B} * (x - mx) + {_C} * (z - mz) - y, 2)"
SQL["ml_eval_holdout"] = f"""SELECT airline, origin, count(*) AS points,
  {half_up(f"avg({_HOLDOUT_ERROR})", 4)} AS mse,
  {half_up(f"sqrt(avg({_HOLDOUT_ERROR}))", 4)} AS rmse_minutes
FROM ({_AFTER}) JOIN (SELECT airline, origin, count(*) AS n, avg(y) AS my, avg(x) AS mx, avg(z) AS mz, var_pop(x) AS sxx,
    var_pop(z) AS szz, covar_pop(x, z) AS sxz, covar_pop(x, y) AS sxy, covar_pop(z, y) AS szy
  FROM ({_BEFORE}) GROUP BY 1, 2) USING (airline, origin) GROUP BY airline, origin"""


def _rounded(source: str) -> str:
    return f"SELECT airport_id, departure_seconds, mean, {half_up('prediction', 4)} AS prediction FROM ({source})"


SQL["ml_ols_all_airports"] = _rounded(_OLS)
SQL["ml_poly_all_airports"] = _rounded(_POLY)
_OFF = "count(*) FILTER (WHERE abs(prediction - mean) > 15)"
SQL["ml_large_error_share"] = " UNION ALL ".join(
    f"SELECT {order} AS polynomial_order, count(*) AS points, {pct(_OFF, 'count(*)')} AS large_error_pct"
    f" FROM ({source})"
    for order, source in ((1, _OLS), (2, _POLY))
)
SQL["ml_pred_vs_obs"] = f"""SELECT count(*) AS points, {half_up("regr_slope(prediction, mean)", 4)} AS slope,
  {half_up("regr_intercept(prediction, mean)", 4)} AS intercept, {half_up("corr(prediction, mean)", 4)} AS correlation
  FROM ({_OLS})"""
SQL["ml_dep_arr_features"] = """SELECT carrier AS airline, departure_seconds, arrival_seconds, origin AS airport_id,
  avg(delay) AS mean, avg(isodow(flight_date) - 1) AS weekday FROM analysed WHERE delay < 60 GROUP BY 1, 2, 3, 4"""


# Ridge over all airports ------------------------------------------------------------------------------
# Every airport's own columns (its level and, for order 2, a slope per time) are eliminated from its sums; the
# rest adds up to a system of the common columns, which is solved by Gaussian elimination, one subquery a step.


def _pair(i: int, j: int, letter: str = "g") -> str:
    return f"{letter}_{min(i, j)}_{max(i, j)}"


def _ridge_fit(train: str, times: list[str], models: list[tuple[int, float]], name: str) -> str:
    """CTEs ``{name}_own`` (airport_id, polynomial_order, alpha, level, slope_1, ...), ``{name}_unseen`` (the same
    of an unseen airport) and ``{name}_common`` (polynomial_order, alpha, c_0, ...) of all ``models`` on the rows ``train``."""
    m = len(times)
    t = [f"({c} / 86400.0::DOUBLE)" for c in times]
    z = ["1.0::DOUBLE", *t, *[f"({t[i]} * {t[j]})" for i in range(m) for j in range(i, m)], "mean"]
    y, last = len(z) - 1, len(z)
    pairs = [(i, j) for i in range(last) for j in range(i, last)]
    listed = ", ".join(f"({order}, {alpha}::DOUBLE)" for order, alpha in models)
    sums = ", ".join(f"sum({z[i]} * {z[j]}) AS {_pair(i, j)}" for i, j in pairs)
    totals = ", ".join(f"sum({_pair(i, j)}) AS {_pair(i, j, 'n')}" for i, j in pairs if i == 0 or i == j)

    def spread(first: str, second: str) -> str:
        return f"alpha * greatest({second} - {first} * {first} / n_0_0, 0)"

    one = f"(g_0_0 + {spread('g_0_0', 'g_0_0')} / polynomial_order)"
    left = ", ".join(f"{_pair(i, j)} - {_pair(0, i)} * {_pair(0, j)} / {one} AS {_pair(i, j, 'h')}" for i, j in pairs)
    block = {
        (i, j): f"h_{i}_{j}" + (f" + {spread(f'g_0_{i}', f'g_{i}_{i}')}" if i == j else "")
        for i in range(1, m + 1) for j in range(i, m + 1)
    }
    blocks = ", ".join(f"{sql} AS b_{i}_{j}" for (i, j), sql in block.items())
    scale = " + ".join(f"g_{i}_{i}" for i in range(1, m + 1))
    trace = "(" + " + ".join(f"b_{i}_{i}" for i in range(1, m + 1)) + ")"
    if m == 1:
        inverse = "CASE WHEN polynomial_order = 1 OR b_1_1 <= 1e-9 * g_1_1 THEN 0.0 ELSE 1 / b_1_1 END AS p_1_1"
    else:
        det = "(b_1_1 * b_2_2 - b_1_2 * b_1_2)"
        other = {(1, 1): "b_2_2", (1, 2): "-b_1_2", (2, 2): "b_1_1"}
        inverse = ", ".join(
            f"CASE WHEN polynomial_order = 1 OR {trace} <= 1e-9 * ({scale}) THEN 0.0 "
            f"WHEN {det} <= 1e-9 * {trace} * {trace} THEN b_{i}_{j} / ({trace} * {trace}) ELSE {swap} / {det} END AS p_{i}_{j}"
            for (i, j), swap in other.items()
        )

    def through(i: int, j: int) -> str:
        return " + ".join(
            f"{_pair(a, i, 'h')} * {_pair(a, b, 'p')} * {_pair(b, j, 'h')}" for a in range(1, m + 1) for b in range(1, m + 1)
        )

    used = []
    for i in range(y):
        if i == 0:
            used.append("alpha > 0")
        elif i <= m:
            used.append("(alpha > 0 OR polynomial_order = 1)")
        else:
            used.append("polynomial_order = 2")
    border = []
    for i, j in pairs:
        if i == y:
            continue
        value = f"sum({_pair(i, j, 'h')} - ({through(i, j)}))"
        if i == j:
            penalty = f" + any_value({spread(f'n_0_{i}', f'n_{i}_{i}')})" if i else ""
            border.append(f"CASE WHEN {used[i]} THEN {value}{penalty} ELSE 1.0 END AS s0_{i}_{j}")
        else:
            both = used[i] if j == y else f"{used[i]} AND {used[j]}"
            border.append(f"CASE WHEN {both} THEN {value} ELSE 0.0 END AS s0_{i}_{j}")
    solved = f"SELECT polynomial_order, alpha, {', '.join(border)} FROM {name}_blocks GROUP BY polynomial_order, alpha"
    for step in range(y - 1):
        kept = [f"s{k}_{k}_{j}" for k in range(step + 1) for j in range(k, y + 1)]
        new = [
            f"s{step}_{i}_{j} - s{step}_{step}_{i} * s{step}_{step}_{j} / s{step}_{step}_{step} AS s{step + 1}_{i}_{j}"
            for i in range(step + 1, y) for j in range(i, y + 1)
        ]
        solved = f"SELECT polynomial_order, alpha, {', '.join(kept + new)} FROM ({solved})"
    for i in range(y - 1, -1, -1):
        known = "".join(f" - s{i}_{i}_{j} * c_{j}" for j in range(i + 1, y))
        solved = f"SELECT *, (s{i}_{i}_{y}{known}) / s{i}_{i}_{i} AS c_{i} FROM ({solved})"
    solved = f"SELECT polynomial_order, alpha, {', '.join(f'c_{i}' for i in range(y))} FROM ({solved})"
    rest = {a: f"(h_{a}_{y}" + "".join(f" - {_pair(a, i, 'h')} * c_{i}" for i in range(y)) + ")" for a in range(1, m + 1)}
    slopes = [" + ".join(f"{_pair(a, b, 'p')} * {rest[b]}" for b in range(1, m + 1)) for a in range(1, m + 1)]
    named = ", ".join(f"{sql} AS slope_{a}" for a, sql in enumerate(slopes, 1))
    level = f"g_0_{y}" + "".join(f" - g_0_{i} * c_{i}" for i in range(y)) + "".join(f" - g_0_{a} * slope_{a}" for a in range(1, m + 1))
    mean = ", ".join(f"CASE WHEN alpha > 0 THEN 0.0 ELSE avg({c}) END AS {c}" for c in ("level", *(f"slope_{a}" for a in range(1, m + 1))))
    return f"""{name}_sums AS (SELECT airport_id, {sums} FROM ({train}) GROUP BY airport_id),
{name}_left AS (SELECT *, {one} AS one, {left} FROM {name}_sums, (SELECT {totals} FROM {name}_sums),
  (VALUES {listed}) AS models(polynomial_order, alpha)),
{name}_blocks AS (SELECT *, {inverse} FROM (SELECT *, {blocks} FROM {name}_left)),
{name}_common AS ({solved}),
{name}_own AS (SELECT airport_id, polynomial_order, alpha, ({level}) / one AS level, {', '.join(f'slope_{a}' for a in range(1, m + 1))}
  FROM (SELECT *, {named} FROM {name}_blocks JOIN {name}_common USING (polynomial_order, alpha))),
{name}_unseen AS (SELECT polynomial_order, alpha, {mean} FROM {name}_own GROUP BY polynomial_order, alpha)"""


def _ridge_predict(rows: str, times: list[str], name: str, where: str = "TRUE") -> str:
    """``rows`` with the prediction of every model of ``name``."""
    t = [f"({c} / 86400.0::DOUBLE)" for c in times]
    z = ["1", *t, *[f"({t[i]} * {t[j]})" for i in range(len(t)) for j in range(i, len(t))]]
    shared = " + ".join(f"c.c_{i} * {x}" for i, x in enumerate(z))
    own = "coalesce(o.level, u.level)" + "".join(
        f" + coalesce(o.slope_{a}, u.slope_{a}) * {x}" for a, x in enumerate(t, 1)
    )
    return f"""SELECT r.*, c.polynomial_order, c.alpha, {shared} + {own} AS prediction
  FROM ({rows}) r CROSS JOIN {name}_common c JOIN {name}_unseen u USING (polynomial_order, alpha)
  LEFT JOIN {name}_own o ON o.airport_id = r.airport_id AND o.polynomial_order = c.polynomial_order AND o.alpha = c.alpha
  WHERE {where}"""


_ALPHAS = [tenths / 10 for tenths in range(0, 20, 2)]
_GRID = [(order, alpha) for order in (1, 2) for alpha in _ALPHAS]
_CUT = {"train": "<", "test": ">"}


def _mean_delays(part: str) -> str:
    return f"""SELECT origin AS airport_id, departure_seconds, avg(delay) AS mean FROM analysed
  WHERE delay < 60 AND carrier = 'AA' AND flight_date {_CUT[part]} DATE '2015-10-01' GROUP BY 1, 2"""


def _route_times(part: str) -> str:
    return f"""SELECT origin AS airport_id, departure_seconds, arrival_seconds, avg(delay) AS mean FROM analysed
  WHERE delay < 60 AND carrier = 'AA' AND flight_date {_CUT[part]} DATE '2015-10-01' GROUP BY 1, 2, 3"""


def _mse(scored: str, *keys: str) -> str:
    listed = "".join(f"{k}, " for k in keys)
    grouped = f" GROUP BY {', '.join(keys)}" if keys else ""
    return f"""SELECT {listed}count(*) AS points, {half_up(f"avg({_ERROR})", 4)} AS mse,
  {half_up(f"sqrt(avg({_ERROR}))", 4)} AS rmse_minutes FROM ({scored}){grouped}"""


def _grid_scope(rows: str, times: list[str], *identity: str) -> str:
    """CTEs for the fits of the grid on 70 % of ``rows`` and their scores on the rest, unrounded."""
    parted = _parts(rows, *identity)
    return f"""{_ridge_fit(f"SELECT * FROM ({parted}) WHERE part = 'train'", times, _GRID, "grid")},
scores AS (SELECT polynomial_order, alpha, avg({_ERROR}) AS mse
  FROM ({_ridge_predict(f"SELECT * FROM ({parted}) WHERE part = 'test'", times, "grid")}) GROUP BY polynomial_order, alpha),
best AS (SELECT polynomial_order, alpha FROM scores ORDER BY mse, polynomial_order, alpha LIMIT 1)"""


_DEPARTURE, _BOTH = ["departure_seconds"], ["departure_seconds", "arrival_seconds"]
_ALL_PARTS = _parts(_AA, "airport_id", "departure_seconds")
_RIDGE = _ridge_fit(f"SELECT * FROM ({_ALL_PARTS}) WHERE part = 'train'", _DEPARTURE, [(2, 0.3)], "ridge")
SQL["ml_ridge"] = f"""SELECT * FROM (WITH {_RIDGE}
{_mse(_ridge_predict(f"SELECT * FROM ({_ALL_PARTS}) WHERE part = 'test'", _DEPARTURE, "ridge"))})"""
SQL["ml_grid_search"] = f"""SELECT * FROM (WITH {_grid_scope(_mean_delays("train"), _DEPARTURE, "airport_id", "departure_seconds")}
SELECT s.polynomial_order, s.alpha, {half_up("s.mse", 4)} AS mse, b.alpha IS NOT NULL AS is_best
FROM scores s LEFT JOIN best b USING (polynomial_order, alpha))"""
_CHOSEN = "(c.polynomial_order, c.alpha) IN (SELECT (polynomial_order, alpha) FROM best)"
_REFIT = _ridge_fit(_mean_delays("train"), _DEPARTURE, _GRID, "refit")
SQL["ml_refit_best"] = f"""SELECT * FROM (WITH {_grid_scope(_mean_delays("train"), _DEPARTURE, "airport_id", "departure_seconds")}, {_REFIT}
{_mse(_ridge_predict(_mean_delays("train"), _DEPARTURE, "refit", _CHOSEN), "polynomial_order", "alpha")})"""
_APPLIED = _ridge_fit(_mean_delays("train"), _DEPARTURE, [(2, 0.2)], "applied")
SQL["ml_apply_train_labels"] = f"""SELECT * FROM (WITH {_APPLIED}
{_rounded(_ridge_predict(_mean_delays("test"), _DEPARTURE, "applied"))})"""
_REFIT_BOTH = _ridge_fit(_route_times("train"), _BOTH, _GRID, "refit")
SQL["ml_model3"] = f"""SELECT * FROM (WITH {_grid_scope(_route_times("train"), _BOTH, *_BOTH, "airport_id")}, {_REFIT_BOTH}
{_mse(_ridge_predict(_route_times("test"), _BOTH, "refit", _CHOSEN), "polynomial_order", "alpha")})"""


# Polynomials by three-term recurrence ----------------------------------------------------------------------
# Each fit uses the polynomials that are orthogonal over its own training points (Forsythe's recurrence); a subquery a step.


def significant(x: str, digits: int = 5) -> str:
    """Rounded to significant digits."""
    power = f"CAST(floor(log10(CASE WHEN {x} > 0 THEN {x} ELSE 1.0 END)) AS INT) - {digits - 1}"
    up, down = f"power(10.0::DOUBLE, {power})", f"power(10.0::DOUBLE, -({power}))"
    return f"(CASE WHEN {power} >= 0 THEN floor({x} / {up} + 0.5) * {up} ELSE floor({x} * {down} + 0.5) / {down} END)"


def _recurrence(points: str, group: str, order: int) -> str:
    """``points`` (group columns, x, y, train) with f_1 .. f_order: the fits of each order on the group's training points."""

    def total(x: str) -> str:
        return f"sum(CASE WHEN train THEN {x} ELSE 0.0 END) OVER (PARTITION BY {group})"

    sql = f"SELECT *, 1.0::DOUBLE AS p_0, {total('1.0::DOUBLE')} AS q_0 FROM ({points})"
    sql = f"SELECT *, {total('y')} / q_0 AS f_0, {total('x')} / q_0 AS a_0 FROM ({sql})"
    for k in range(1, order + 1):
        before = f" - q_{k - 1} / q_{k - 2} * p_{k - 2}" if k > 1 else ""
        # As many points as unknowns at most: beyond, the polynomial vanishes on all of them.
        sql = f"SELECT *, CASE WHEN q_0 > {k} THEN (x - a_{k - 1}) * p_{k - 1}{before} ELSE 0.0 END AS p_{k} FROM ({sql})"
        sql = f"SELECT *, CASE WHEN q_0 > {k} THEN {total(f'p_{k} * p_{k}')} ELSE 1.0 END AS q_{k} FROM ({sql})"
        rest = f"(y - f_{k - 1})"
        sql = f"""SELECT *, f_{k - 1} + {total(f'{rest} * p_{k}')} / q_{k} * p_{k} AS f_{k},
  {total(f'x * p_{k} * p_{k}')} / q_{k} AS a_{k} FROM ({sql})"""
    return sql


_X = "departure_seconds / 43200.0::DOUBLE - 1.0"
_FOLDED = f"""SELECT *, ntile(10) OVER (PARTITION BY airline, origin ORDER BY departure_seconds) AS fold,
  count(*) OVER (PARTITION BY airline, origin) AS points FROM ({_TRIMMED})"""
_HELD = f"""SELECT airline, origin, points, {_X} AS x, mean AS y, held, fold <> held AS train
  FROM ({_FOLDED}), range(1, 11) AS folds(held) WHERE points >= 10"""
_CV = _recurrence(_HELD, "airline, origin, held", 7)
SQL["ml_poly_cv"] = " UNION ALL ".join(
    f"""SELECT airline, origin, {k} AS polynomial_order, points, {significant("avg(error)")} AS mse FROM (
  SELECT airline, origin, points, held, avg(power(f_{k} - y, 2)) AS error FROM fitted WHERE NOT train
  GROUP BY airline, origin, points, held) GROUP BY airline, origin, points"""
    for k in range(1, 8)
)
SQL["ml_poly_cv"] = f"SELECT * FROM (WITH fitted AS MATERIALIZED ({_CV}) {SQL['ml_poly_cv']})"
_SEEDED = "concat_ws('|', CAST(split AS VARCHAR), airline, origin, CAST(departure_seconds AS VARCHAR))"
_SPLITS = f"""SELECT airline, origin, split, {_X} AS x, mean AS y,
  CAST('0x' || substr(md5({_SEEDED}), 1, 8) AS BIGINT) % 10 < 7 AS train
  FROM ({_TRIMMED}), (SELECT CAST(range AS INT) AS split FROM range(1, 41))"""
_MSE_BY_ORDER = ", ".join(f"avg(power(f_{k} - y, 2)) FILTER (NOT train) AS m_{k}" for k in (1, 2, 3))
SQL["ml_split_bias"] = f"""SELECT airline, origin, split, CASE WHEN m_1 <= m_2 AND m_1 <= m_3 THEN 1 WHEN m_2 <= m_3 THEN 2
  ELSE 3 END AS best_order, {significant("least(m_1, m_2, m_3)")} AS best_mse,
  {", ".join(f"{significant(f'm_{k}')} AS mse_{k}" for k in (1, 2, 3))}
FROM (SELECT airline, origin, split, {_MSE_BY_ORDER} FROM ({_recurrence(_SPLITS, "airline, origin, split", 3)})
  GROUP BY airline, origin, split HAVING bool_or(train) AND bool_or(NOT train))"""


def oracle(name: str) -> str | None:
    return with_flights(SQL[name]) if name in SQL else None
