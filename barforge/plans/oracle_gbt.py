"""DuckDB SQL of the boosted trees: cells, bins, histograms, splits and scores from their definitions.

One round of the recursion is one level of one tree over all rows (role 0:
training, 1: held out, 2: to be scored), so the early stop decides as it does
in training.  Gradients are whole millionths, as there.
"""

from __future__ import annotations

from barforge.plans import oracle_base as O

EVAL = f"{O.u01(chr(39) + 'split' + chr(39), 'symbol', 'date')} < 0.2::DOUBLE"


def _cell(x: str) -> str:
    return f"""(SELECT CASE WHEN v = 0 THEN 0 ELSE CAST(sign(v) * ((p + 1100) * 256 + floor((abs(v) / pow(2.0::DOUBLE, p) - 1) * 256) + 1) AS BIGINT) END FROM
      (SELECT v, CASE WHEN abs(v) / pow(2.0::DOUBLE, q) < 1 THEN q - 1 WHEN abs(v) / pow(2.0::DOUBLE, q) >= 2 THEN q + 1 ELSE q END AS p FROM
        (SELECT v, CASE WHEN v <> 0 THEN floor(log2(abs(v))) END AS q FROM (SELECT {O.R(f"CAST({x} AS DOUBLE)", 8)} AS v))))"""


def boosted(name: str, features: list[str], text: tuple[str, ...] = ("symbol", "month_end_zone"), max_iter: int = 50, depth: int = 6, step: float = 0.1, l1: float = 0.1,
            l2: float = 0.1, bins: int = 64, min_rel: float = 0.01, label: str = "next_day_return") -> str:
    """CTEs ``{name}_walk`` (every round's rows) and ``{name}_score`` (date, symbol, pred of the rows to be scored) over ``feat``."""
    n = name
    at = [i for i, f in enumerate(features) if f in text]
    cells = "\n  UNION ALL ".join(
        f"SELECT date, symbol, role, {i} AS f, " + (f"(SELECT rnk FROM {n}_val t WHERE t.f = {i} AND t.val = s.{f})" if i in at else _cell(f"s.{f}"))
        + f" AS cell FROM {n}_rows s" for i, f in enumerate(features))
    values = " UNION ALL ".join(
        f"SELECT {i} AS f, {features[i]} AS val, ROW_NUMBER() OVER (ORDER BY {features[i]}) AS rnk FROM "
        f"(SELECT DISTINCT {features[i]} FROM {n}_rows WHERE role < 2 AND {features[i]} IS NOT NULL)" for i in at) or "SELECT -1 AS f, '' AS val, 0 AS rnk"
    in_text = f"f IN ({', '.join(map(str, at))})" if at else "false"
    long_in_text = f"l.f IN ({', '.join(map(str, at))})" if at else "false"
    bin_in_text = f"b.f IN ({', '.join(map(str, at))})" if at else "false"

    def drawn(g: str) -> str:
        x = f"(({g})::DOUBLE / 1000000)"
        return f"(CASE WHEN {x} > {l1}::DOUBLE THEN {x} - {l1}::DOUBLE WHEN {x} < -{l1}::DOUBLE THEN {x} + {l1}::DOUBLE ELSE 0.0::DOUBLE END)"

    def worth(g: str, h: str) -> str:
        return f"({drawn(g)} * {drawn(g)} / (({h})::DOUBLE + {l2}::DOUBLE))"

    return f"""
{n}_rows AS MATERIALIZED (
  SELECT *, CASE WHEN date >= CAST((SELECT d FROM as_of) - INTERVAL 180 DAY AS DATE) THEN 2 WHEN {EVAL} THEN 1 ELSE 0 END AS role,
         CAST(floor({label} * 1000000 + 0.5) AS BIGINT) AS y FROM feat
  WHERE date >= CAST((SELECT d FROM as_of) - INTERVAL 180 DAY AS DATE) OR {label} IS NOT NULL),
{n}_val AS MATERIALIZED ({values}),
{n}_long AS MATERIALIZED ({cells}),
{n}_edge AS MATERIALIZED (
  SELECT f, cell FROM (SELECT f, cell, c, sum(c) OVER (PARTITION BY f ORDER BY cell)::BIGINT AS upto, sum(c) OVER (PARTITION BY f)::BIGINT AS total
    FROM (SELECT f, cell, count(*) AS c FROM {n}_long WHERE role = 0 AND cell IS NOT NULL AND NOT {in_text} GROUP BY ALL))
  WHERE upto * {bins} // total > (upto - c) * {bins} // total AND upto < total),
{n}_place AS MATERIALIZED (
  SELECT k.f, k.cell, 1 + count(e.cell) AS b FROM (SELECT DISTINCT f, cell FROM {n}_long WHERE cell IS NOT NULL AND NOT {in_text}) k
  LEFT JOIN {n}_edge e ON e.f = k.f AND e.cell < k.cell GROUP BY ALL),
{n}_bin AS MATERIALIZED (
  SELECT date, symbol, l.f, (CASE WHEN l.cell IS NULL THEN 0 WHEN {long_in_text} THEN l.cell ELSE p.b END)::BIGINT AS b
  FROM {n}_long l LEFT JOIN {n}_place p ON p.f = l.f AND p.cell = l.cell),
{n}_walk(it, t, lvl, date, symbol, role, y, node, pred, before, was, sf, sgain, sb, snone, went, leaf_value) AS (
  SELECT 0, 0, 0, date, symbol, role, y, 1::BIGINT, (SELECT sum(y)::DOUBLE / count(*) / 1000000 FROM {n}_rows WHERE role = 0), NULL::DOUBLE, 0::BIGINT, NULL::INT, NULL::DOUBLE,
         NULL::BIGINT, NULL::BOOLEAN, NULL::BIGINT, NULL::DOUBLE
  FROM {n}_rows
  UNION ALL (
  WITH cur AS (SELECT *, CAST(floor(pred * 1000000 - y + 0.5) AS BIGINT) AS g FROM {n}_walk),
  stop AS (SELECT *, t < {max_iter} AND (lvl > 0 OR before IS NULL OR (before <> 0 AND (before - loss) / before >= {min_rel}::DOUBLE)) AS go FROM
           (SELECT max(t) AS t, max(lvl) AS lvl, max(before) AS before, sum(CASE WHEN role = 1 THEN g::HUGEINT * g END)::DOUBLE AS loss FROM cur)),
  hist AS (SELECT node, f, b, sum(g)::BIGINT AS g, count(*) AS h FROM cur JOIN {n}_bin USING (date, symbol), stop
           WHERE role = 0 AND go AND node >= (1 << stop.lvl) GROUP BY ALL),
  cum AS (SELECT *, sum(g) OVER a AS g_all, sum(h) OVER a AS h_all, sum(CASE WHEN b = 0 THEN g ELSE 0 END) OVER a AS g_none,
                 sum(CASE WHEN b = 0 THEN h ELSE 0 END) OVER a AS h_none,
                 sum(CASE WHEN b > 0 THEN g ELSE 0 END) OVER u AS g_upto, sum(CASE WHEN b > 0 THEN h ELSE 0 END) OVER u AS h_upto
          FROM hist WINDOW a AS (PARTITION BY node, f), u AS (PARTITION BY node, f ORDER BY b)),
  opt AS (SELECT node, f, b, g_all, h_all, false AS none_left, CASE WHEN {in_text} THEN g ELSE g_upto END AS gl, CASE WHEN {in_text} THEN h ELSE h_upto END AS hl FROM cum WHERE b > 0
          UNION ALL SELECT node, f, b, g_all, h_all, true, g_upto + g_none, h_upto + h_none FROM cum WHERE b > 0 AND h_none > 0 AND NOT {in_text}),
  gain AS (SELECT *, {worth('gl', 'hl')} + {worth('g_all - gl', 'h_all - hl')} - {worth('g_all', 'h_all')} AS gain FROM opt WHERE hl >= 1 AND h_all - hl >= 1),
  best AS (SELECT node, f AS bf, b AS bb, none_left, gain FROM gain WHERE gain > 0
           QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, b, none_left) = 1),
  moved AS (SELECT cur.*, bf, bb, none_left, gain, CASE WHEN bf IS NULL THEN cur.node
              ELSE 2 * cur.node + CASE WHEN (CASE WHEN {bin_in_text} THEN b.b = bb WHEN b.b = 0 THEN none_left ELSE b.b <= bb END) THEN 0 ELSE 1 END END AS nn
            FROM cur LEFT JOIN best ON best.node = cur.node LEFT JOIN {n}_bin b ON b.date = cur.date AND b.symbol = cur.symbol AND b.f = bf),
  leaf AS (SELECT nn, sum(g)::BIGINT AS g, count(*) AS h FROM moved WHERE role = 0 GROUP BY nn)
  SELECT it + 1, CASE WHEN s.lvl + 1 = {depth} THEN m.t + 1 ELSE m.t END, CASE WHEN s.lvl + 1 = {depth} THEN 0 ELSE s.lvl + 1 END, date, symbol, role, y,
         CASE WHEN s.lvl + 1 = {depth} THEN 1 ELSE m.nn END,
         CASE WHEN s.lvl + 1 = {depth} THEN pred + {step}::DOUBLE * (-{drawn('leaf.g')} / (leaf.h::DOUBLE + {l2}::DOUBLE)) ELSE pred END,
         CASE WHEN s.lvl = 0 THEN s.loss ELSE m.before END, m.node, bf, gain, bb, none_left, m.nn,
         CASE WHEN s.lvl + 1 = {depth} THEN {step}::DOUBLE * (-{drawn('leaf.g')} / (leaf.h::DOUBLE + {l2}::DOUBLE)) END
  FROM moved m JOIN stop s ON s.go LEFT JOIN leaf ON leaf.nn = m.nn)),
{n}_score AS (SELECT date, symbol, pred FROM {n}_walk WHERE role = 2 AND it = (SELECT max(it) FROM {n}_walk))"""


def attributions(name: str, features: list[str], text: tuple[str, ...] = ("symbol", "month_end_zone"), depth: int = 6, k: int = 10) -> str:
    """CTE ``{name}_top`` (date, symbol, feature, attribution, rank): Shapley values by their definition, all subsets of the features that a
    leaf's path asks about, for every leaf of the trees of ``{name}_walk``."""
    n = name
    at = [i for i, f in enumerate(features) if f in text]
    in_text = f"p.f IN ({', '.join(map(str, at))})" if at else "false"
    names = ", ".join(f"({i}, '{f}')" for i, f in enumerate(features))
    return f"""
{n}_split AS MATERIALIZED (SELECT DISTINCT (it - 1) // {depth} AS tree, was AS node, sf AS f, sb AS b, snone AS none_left FROM {n}_walk WHERE sf IS NOT NULL),
{n}_cover AS MATERIALIZED (
  SELECT (it - 1) // {depth} AS tree, went AS node, max(c) AS c FROM (SELECT it, went, count(*) AS c FROM {n}_walk WHERE role = 0 AND it > 0 GROUP BY ALL) GROUP BY ALL
  UNION ALL SELECT DISTINCT (it - 1) // {depth}, 1, (SELECT count(*) FROM {n}_rows WHERE role = 0) FROM {n}_walk WHERE it > 0
    AND (it - 1) // {depth} NOT IN (SELECT (it - 1) // {depth} FROM {n}_walk WHERE role = 0 AND went = 1 AND it > 0)),
{n}_leaf AS MATERIALIZED (SELECT DISTINCT (it - 1) // {depth} AS tree, went AS leaf, leaf_value AS v FROM {n}_walk WHERE leaf_value IS NOT NULL),
{n}_path AS MATERIALIZED (
  SELECT l.tree, l.leaf, s.f, s.b, s.none_left, (l.leaf >> (d - 1)) & 1 AS side, below.c::DOUBLE / here.c AS share
  FROM {n}_leaf l, (SELECT unnest(range(1, {depth} + 1)) AS d) JOIN {n}_split s ON s.tree = l.tree AND s.node = l.leaf >> d
  JOIN {n}_cover here ON here.tree = l.tree AND here.node = l.leaf >> d JOIN {n}_cover below ON below.tree = l.tree AND below.node = l.leaf >> (d - 1)),
{n}_asked AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree, leaf ORDER BY f) - 1 AS j FROM
  (SELECT tree, leaf, f, product(share) AS z FROM {n}_path GROUP BY tree, leaf, f)),
{n}_many AS MATERIALIZED (SELECT tree, leaf, count(*) AS m FROM {n}_asked GROUP BY ALL),
{n}_outcome AS MATERIALIZED (
  SELECT tree, leaf, date, symbol, sum(CASE WHEN yes THEN 1 << j ELSE 0 END) AS outcome FROM (
    SELECT p.tree, p.leaf, p.f, x.date, x.symbol,
           bool_and((CASE WHEN {in_text} THEN x.b = p.b WHEN x.b = 0 THEN p.none_left ELSE x.b <= p.b END) = (p.side = 0)) AS yes
    FROM {n}_path p JOIN {n}_bin x ON x.f = p.f JOIN {n}_rows r ON r.date = x.date AND r.symbol = x.symbol AND r.role = 2 GROUP BY ALL)
  JOIN {n}_asked USING (tree, leaf, f) GROUP BY ALL),
{n}_subset AS MATERIALIZED (
  -- weight of a subset of the other features times the chance of the path given it, for every outcome
  SELECT i.tree, i.leaf, i.f, i.j AS own, i.z AS own_z, o.outcome, c.chosen, gamma(bit_count(c.chosen) + 1) * gamma(m.m - bit_count(c.chosen)) / gamma(m.m + 1) AS weight,
         product(CASE WHEN (c.chosen >> a.j) & 1 = 1 THEN ((o.outcome >> a.j) & 1)::DOUBLE WHEN a.j = i.j THEN 1.0 ELSE a.z END) AS chance
  FROM {n}_asked i JOIN {n}_many m USING (tree, leaf) JOIN (SELECT unnest(range(0, 1 << {depth})) AS outcome) o ON o.outcome < (1 << m.m)
  JOIN (SELECT unnest(range(0, 1 << {depth})) AS chosen) c ON c.chosen < (1 << m.m) AND (c.chosen >> i.j) & 1 = 0
  JOIN {n}_asked a ON a.tree = i.tree AND a.leaf = i.leaf GROUP BY i.tree, i.leaf, i.f, i.j, i.z, o.outcome, c.chosen, m.m),
{n}_table AS MATERIALIZED (
  SELECT tree, leaf, f, outcome, sum(weight * chance) * (((outcome >> own) & 1) - own_z) * v AS a
  FROM {n}_subset JOIN {n}_leaf USING (tree, leaf) GROUP BY tree, leaf, f, outcome, own, own_z, v),
{n}_shapley AS (SELECT date, symbol, f, sum(a) AS a FROM {n}_outcome JOIN {n}_table USING (tree, leaf, outcome) GROUP BY ALL),
{n}_top AS (
  SELECT date, symbol, feature, attribution, row_number() OVER (PARTITION BY date, symbol ORDER BY abs(attribution) DESC, feature)::INT AS rank FROM (
    SELECT r.date, r.symbol, f.feature, coalesce(s.a, 0) AS attribution FROM {n}_rows r, (VALUES {names}) f(i, feature)
    LEFT JOIN {n}_shapley s ON s.date = r.date AND s.symbol = r.symbol AND s.f = f.i WHERE r.role = 2)
  QUALIFY rank <= {k})"""


def with_recursive(sql: str) -> str:
    return "WITH RECURSIVE" + sql[4:] if sql.startswith("WITH") else sql
