"""SQL oracles: for each registered query, an independent DuckDB statement over
the same parquet tables (views ``events``, ``documents``, ``labels``,
``embeddings``, ``lineitem`` ...). One-hot fits are unrolled iteration by iteration
as CTEs, the longer fits of the grid are one recursive CTE; both include the
early-stop rule.
"""

from __future__ import annotations

import math

from .workflow import GRID_ITERATIONS, GRID_REGS, GRID_STEPS, OHE_FIT
from .registry import COLLISION_BUCKETS

BUCKETS = 2 ** 15
WS = "(' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12))"
TAB = "chr(9)"


def r6(expr: str, digits: int = 6) -> str:
    """Round like ``registry.rounded`` (and fold -0.0 into 0.0)."""
    return f"(round(({expr})::DOUBLE, {digits}) + 0.0)"


def lit(x: float) -> str:
    return f"({float(x)!r})::DOUBLE"


def log_loss_sql(p: str, y: str) -> str:
    q = (f"(CASE WHEN ({p}) = 0 THEN ({p}) + {lit(10e-12)} "
         f"WHEN ({p}) = 1 THEN ({p}) - {lit(10e-12)} ELSE ({p}) END)")
    return f"(CASE WHEN ({y}) = 1 THEN -ln({q}) WHEN ({y}) = 0 THEN -ln(1.0 - {q}) END)"


def sigmoid_clamped(z: str) -> str:
    return f"(1.0 / (1.0 + exp(-greatest(-20.0, least(20.0, {z})))))"


def unit_hash_sql(key: str, seed: int = 42) -> str:
    return (f"(('0x' || substr(md5('{seed}:' || ({key})::VARCHAR), 1, 8))::BIGINT::DOUBLE"
            f" / 4294967296.0::DOUBLE)")


def md5_bucket_sql(s: str, n: int) -> str:
    return f"((('0x' || md5({s}))::UHUGEINT % {n})::INTEGER)"


# --- shared CTEs -----------------------------------------------------------------

CE = f"""ce AS (
  SELECT event_id::BIGINT AS row_id,
         (CASE WHEN event_type = 'click' THEN 1 ELSE 0 END)::DOUBLE AS label,
         hour(ts)::VARCHAR AS f0, isodow(ts)::VARCHAR AS f1, user_id::VARCHAR AS f2,
         coalesce(json_extract_string(props, '$.k'), '') AS f3,
         CASE WHEN value < 5.0 THEN '' ELSE floor(value / 10)::INTEGER::VARCHAR END AS f4,
         event_type
  FROM events),
ces AS (
  SELECT *, CASE WHEN u < 0.8 THEN 'train' WHEN u < 0.9 THEN 'validation' ELSE 'test' END AS split
  FROM (SELECT *, {unit_hash_sql('row_id')} AS u FROM ce)),
cel AS (
  SELECT row_id, label, split, unnest([0, 1, 2, 3, 4])::INTEGER AS feature_id,
         unnest([f0, f1, f2, f3, f4]) AS category
  FROM ces),
dict AS (
  SELECT feature_id, category, (row_number() OVER (ORDER BY feature_id, category) - 1)::INTEGER AS idx, n
  FROM (SELECT feature_id, category, count(*)::BIGINT AS n FROM cel WHERE split = 'train' GROUP BY ALL))"""


def content_split_ctes(content: str, table: str) -> str:
    """``parts``: rows of ``table`` with the split of their content id."""
    return f"""numbered AS (
  SELECT {content} AS content, row_number() OVER (PARTITION BY {content}) - 1 AS copy FROM {table}),
ided AS (
  SELECT ('0x' || substr(md5(content || chr(10) || copy::VARCHAR), 1, 15))::BIGINT AS row_id FROM numbered),
parts AS (
  SELECT CASE WHEN u < 0.8 THEN 'train' WHEN u < 0.9 THEN 'validation' ELSE 'test' END AS split
  FROM (SELECT {unit_hash_sql('row_id')} AS u FROM ided))"""


def ohe_ctes() -> str:
    parts = [CE]
    for s in ("train", "validation", "test"):
        parts.append(f"""rows_{s} AS (SELECT row_id, label FROM ces WHERE split = '{s}'),
ohe_{s} AS (
  SELECT c.row_id, c.label, d.idx, 1.0::DOUBLE AS value
  FROM cel c JOIN dict d ON d.feature_id = c.feature_id AND d.category = c.category
  WHERE c.split = '{s}')""")
    return ",\n".join(parts)


def hash_ctes(n: int = BUCKETS) -> str:
    parts = [CE, f"""hstr AS (SELECT DISTINCT row_id, category || feature_id::VARCHAR AS s FROM cel),
hlong AS (
  SELECT row_id, idx, count(*)::DOUBLE AS value
  FROM (SELECT row_id, {md5_bucket_sql('s', n)} AS idx FROM hstr) GROUP BY row_id, idx)"""]
    for s in ("train", "validation", "test"):
        parts.append(f"""rows_{s} AS (SELECT row_id, label FROM ces WHERE split = '{s}'),
hash_{s} AS (
  SELECT h.row_id, r.label, h.idx, h.value FROM hlong h JOIN rows_{s} r ON r.row_id = h.row_id)""")
    return ",\n".join(parts)


def fit_ctes(p: str, rows: str, long: str, k: int, step: float, reg: float,
             tol: float = 1e-3) -> str:
    """Gradient descent from bias 1.0, weights 0.0; final weights in ``{p}_wf``,
    iterations run in ``{p}_it``."""
    c = [f"{p}_n AS MATERIALIZED (SELECT count(*)::DOUBLE AS n FROM {rows})",
         f"""{p}_w0 AS MATERIALIZED (
  SELECT DISTINCT idx, 0.0::DOUBLE AS w FROM {long} UNION ALL SELECT -1 AS idx, 1.0::DOUBLE AS w)"""]
    for i in range(1, k + 1):
        s = float(step) / math.sqrt(i)
        shrink = 1.0 - s * float(reg)
        c.append(f"""{p}_m{i} AS MATERIALIZED (
  SELECT r.row_id, r.label,
         (SELECT w FROM {p}_w{i-1} WHERE idx = -1) + coalesce(sum(l.value * w.w), 0.0) AS margin
  FROM {rows} r LEFT JOIN {long} l ON l.row_id = r.row_id
       LEFT JOIN {p}_w{i-1} w ON w.idx = l.idx
  GROUP BY r.row_id, r.label)""")
        c.append(f"""{p}_r{i} AS MATERIALIZED (
  SELECT row_id, 1.0 / (1.0 + exp(-margin)) - label AS resid FROM {p}_m{i})""")
        c.append(f"""{p}_g{i} AS MATERIALIZED (
  SELECT l.idx, sum(l.value * r.resid) / (SELECT n FROM {p}_n) AS g
  FROM {long} l JOIN {p}_r{i} r ON r.row_id = l.row_id GROUP BY l.idx
  UNION ALL SELECT -1 AS idx, sum(resid) / (SELECT n FROM {p}_n) AS g FROM {p}_r{i})""")
        c.append(f"""{p}_w{i} AS MATERIALIZED (
  SELECT w.idx, w.w * {lit(shrink)} - {lit(s)} * coalesce(g.g, 0.0) AS w
  FROM {p}_w{i-1} w LEFT JOIN {p}_g{i} g ON g.idx = w.idx)""")
    for i in range(2, k + 1):
        c.append(f"""{p}_c{i} AS MATERIALIZED (
  SELECT sqrt(sum((a.w - b.w) * (a.w - b.w))) < {lit(tol)} * greatest(sqrt(sum(a.w * a.w)), 1.0) AS conv
  FROM {p}_w{i} a JOIN {p}_w{i-1} b ON a.idx = b.idx)""")
    if k >= 2:
        convs = " UNION ALL ".join(f"SELECT {i} AS i, conv FROM {p}_c{i}" for i in range(2, k + 1))
        c.append(f"{p}_it AS MATERIALIZED (SELECT coalesce(min(i), {k})::INTEGER AS it "
                 f"FROM ({convs}) WHERE conv)")
    else:
        c.append(f"{p}_it AS MATERIALIZED (SELECT 1::INTEGER AS it)")
    picks = " UNION ALL ".join(
        f"SELECT idx, w FROM {p}_w{i} WHERE (SELECT it FROM {p}_it) = {i}" for i in range(1, k + 1))
    c.append(f"{p}_wf AS MATERIALIZED ({picks})")
    return ",\n".join(c)


def predict_cte(name: str, p: str, rows: str, long: str) -> str:
    z = f"(SELECT w FROM {p}_wf WHERE idx = -1) + coalesce(sum(l.value * w.w), 0.0)"
    return f"""{name} AS (
  SELECT r.row_id, r.label, {sigmoid_clamped(z)} AS score
  FROM {rows} r LEFT JOIN {long} l ON l.row_id = r.row_id LEFT JOIN {p}_wf w ON w.idx = l.idx
  GROUP BY r.row_id, r.label)"""


def grid_ctes(rows: str, long: str, configs, k: int, tol: float = 1e-3) -> str:
    """All cells of a grid in one recursion, a step of which holds the weights of the
    cells still running (the bias is a stored entry of index -1); last weights in ``gf``."""
    cells = ", ".join(f"({g}, {lit(s)}, {lit(r)})" for g, (s, r) in enumerate(configs))
    return f"""cfg(g, step, reg) AS (VALUES {cells}),
gn AS MATERIALIZED (SELECT count(*)::DOUBLE AS n FROM {rows}),
gl AS MATERIALIZED (
  SELECT row_id, label, idx, value FROM {long}
  UNION ALL SELECT row_id, label, -1 AS idx, 1.0::DOUBLE AS value FROM {rows}),
gw AS (
  SELECT g, 0 AS i, idx, (CASE WHEN idx = -1 THEN 1.0 ELSE 0.0 END)::DOUBLE AS w, FALSE AS done
  FROM cfg CROSS JOIN (SELECT DISTINCT idx FROM gl)
  UNION ALL (
  WITH m AS (
    SELECT w.g, l.row_id, 1.0 / (1.0 + exp(-sum(l.value * w.w))) - any_value(l.label) AS resid
    FROM gl l JOIN gw w ON w.idx = l.idx WHERE NOT w.done AND w.i < {k} GROUP BY w.g, l.row_id),
  d AS (
    SELECT m.g, l.idx, sum(l.value * m.resid) / (SELECT n FROM gn) AS s
    FROM gl l JOIN m ON m.row_id = l.row_id GROUP BY m.g, l.idx),
  nxt AS (
    SELECT w.g, w.i + 1 AS i, w.idx, w.w AS old,
           w.w * (1.0 - c.step / sqrt(w.i + 1) * c.reg) - c.step / sqrt(w.i + 1) * d.s AS w
    FROM gw w JOIN cfg c ON c.g = w.g JOIN d ON d.g = w.g AND d.idx = w.idx)
  SELECT g, i, idx, w, i > 1 AND sqrt(sum((w - old) * (w - old)) OVER (PARTITION BY g))
         < {lit(tol)} * greatest(sqrt(sum(w * w) OVER (PARTITION BY g)), 1.0) AS done
  FROM nxt)),
gf AS MATERIALIZED (SELECT g, i, idx, w FROM gw QUALIFY i = max(i) OVER (PARTITION BY g))"""


def grid_predict(name: str, rows: str, long: str) -> str:
    return f"""{name} AS (
  SELECT w.g, l.row_id, any_value(l.label) AS label, {sigmoid_clamped('sum(l.value * w.w)')} AS score
  FROM (SELECT row_id, label, idx, value FROM {long}
        UNION ALL SELECT row_id, label, -1, 1.0 FROM {rows}) l JOIN gf w ON w.idx = l.idx
  GROUP BY w.g, l.row_id)"""


def ohe_fit(k: int = OHE_FIT["iterations"]) -> str:
    return ",\n".join([ohe_ctes(), fit_ctes("f", "rows_train", "ohe_train", k,
                                            OHE_FIT["step_size"], OHE_FIT["reg_param"])])


# --- the statements ----------------------------------------------------------------

def _sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["parse_long"] = f"""WITH {CE},
lines AS (SELECT row_id, concat_ws({TAB}, label::INTEGER::VARCHAR, f0, f1, f2, f3, f4) AS line FROM ce),
parts AS (SELECT row_id, string_split(trim(line, {WS}), {TAB}) AS p FROM lines WHERE trim(line, {WS}) <> '')
SELECT row_id, (CASE WHEN p[1] = '0' THEN 0.0 ELSE 1.0 END)::DOUBLE AS label,
       unnest(range(len(p) - 1))::INTEGER AS feature_id, unnest(p[2:]) AS category
FROM parts"""

    q["text_file_long"] = f"""WITH {CE},
lines AS (SELECT concat_ws({TAB}, label::INTEGER::VARCHAR, f0, f1, f2, f3, f4) AS line FROM ce),
parts AS (SELECT string_split(trim(line, {WS}), {TAB}) AS p FROM lines WHERE trim(line, {WS}) <> '')
SELECT (CASE WHEN p[1] = '0' THEN 0.0 ELSE 1.0 END)::DOUBLE AS label,
       unnest(range(len(p) - 1))::INTEGER AS feature_id, unnest(p[2:]) AS category
FROM parts"""

    q["blank_and_ragged_lines"] = f"""WITH {CE},
lines AS (
  SELECT row_id, CASE WHEN event_type = 'signup' THEN ' ' || {TAB} || ' '
         ELSE concat_ws({TAB}, label::INTEGER::VARCHAR, f0, f4, f1, '', ' ') END AS line
  FROM ce),
parts AS (SELECT row_id, string_split(trim(line, {WS}), {TAB}) AS p FROM lines)
SELECT row_id, (CASE WHEN p[1] = '0' THEN 0.0 ELSE 1.0 END)::DOUBLE AS label,
       greatest(len(p) - 1, 0)::INTEGER AS n_features,
       coalesce(array_to_string(p[2:], '|'), '') AS categories
FROM parts"""

    q["split_sizes"] = f"""WITH {CE}
SELECT coalesce(split, 'total') AS split, count(*)::BIGINT AS n_rows FROM ces GROUP BY ROLLUP (split)"""

    q["text_split_sizes"] = f"""WITH {CE},
lines AS (SELECT concat_ws(chr(9), label::INTEGER::VARCHAR, f0, f1, f2, f3, f4) AS line FROM ce),
{content_split_ctes('line', 'lines')}
SELECT coalesce(split, 'total') AS split, count(*)::BIGINT AS n_rows FROM parts GROUP BY ROLLUP (split)"""

    q["random_split_native"] = None  # partition-dependent: rows-only check

    q["random_split_check"] = """SELECT count(*)::BIGINT AS n_rows, count(*)::BIGINT AS n_split,
  count(DISTINCT event_id)::BIGINT AS n_ids, TRUE AS shares_hold FROM events"""

    q["distinct_features"] = f"""WITH {CE}
SELECT DISTINCT feature_id, category FROM cel WHERE split = 'train'"""

    q["categories_per_feature"] = f"""WITH {CE}
SELECT feature_id, count(DISTINCT category)::BIGINT AS n_categories
FROM cel WHERE split = 'train' GROUP BY feature_id ORDER BY feature_id"""

    q["ohe_dictionary"] = f"WITH {CE}\nSELECT feature_id, category, idx, n FROM dict"
    q["ohe_dictionary_size"] = f"WITH {CE}\nSELECT count(*)::BIGINT AS n_features FROM dict"
    q["ohe_lookup"] = (f"WITH {CE}\nSELECT feature_id, category, idx FROM dict "
                       f"WHERE feature_id = 4 AND category = ''")
    q["ohe_encode_train"] = f"WITH {ohe_ctes()}\nSELECT row_id, label, idx, value FROM ohe_train"
    q["ohe_encode_validation"] = (f"WITH {ohe_ctes()}\n"
                                  f"SELECT row_id, label, idx, value FROM ohe_validation")
    q["ohe_encode_validation_shuffled"] = q["ohe_encode_validation"]
    q["ohe_empty_rows"] = f"""WITH {ohe_ctes()},
r AS (SELECT * FROM rows_validation UNION ALL SELECT * FROM rows_test),
o AS (SELECT * FROM ohe_validation UNION ALL SELECT * FROM ohe_test)
SELECT r.row_id, r.label, count(o.idx)::INTEGER AS nnz
FROM r LEFT JOIN o ON o.row_id = r.row_id GROUP BY r.row_id, r.label"""

    doc = f"""dq AS (
  SELECT l.doc_id::BIGINT AS row_id, l.quality::DOUBLE AS label,
         coalesce(d.lang, '') AS f0, coalesce(d.source, '') AS f1,
         coalesce(l.toxic::VARCHAR, '') AS f2, coalesce(length(d.n_chars::VARCHAR)::VARCHAR, '') AS f3
  FROM labels l JOIN documents d ON d.doc_id = l.doc_id),
dqs AS (
  SELECT *, CASE WHEN u < 0.8 THEN 'train' WHEN u < 0.9 THEN 'validation' ELSE 'test' END AS split
  FROM (SELECT *, {unit_hash_sql('row_id')} AS u FROM dq)),
dql AS (SELECT row_id, label, split, unnest([0, 1, 2, 3])::INTEGER AS feature_id,
               unnest([f0, f1, f2, f3]) AS category FROM dqs),
ddict AS (
  SELECT feature_id, category, (row_number() OVER (ORDER BY feature_id, category) - 1)::INTEGER AS idx, n
  FROM (SELECT feature_id, category, count(*)::BIGINT AS n FROM dql WHERE split = 'train' GROUP BY ALL))"""
    q["doc_quality_dictionary"] = f"WITH {doc}\nSELECT feature_id, category, idx, n FROM ddict"
    q["doc_quality_encode_test"] = f"""WITH {doc}
SELECT r.row_id, r.label, count(d.idx)::INTEGER AS nnz
FROM dqs r JOIN dql l ON l.row_id = r.row_id
     LEFT JOIN ddict d ON d.feature_id = l.feature_id AND d.category = l.category
WHERE r.split = 'test' GROUP BY r.row_id, r.label"""

    q["doc_quality_fit"] = f"""WITH {doc},
drows_train AS (SELECT row_id, label FROM dqs WHERE split = 'train'),
dohe_train AS (
  SELECT l.row_id, l.label, d.idx, 1.0::DOUBLE AS value
  FROM dql l JOIN ddict d ON d.feature_id = l.feature_id AND d.category = l.category
  WHERE l.split = 'train'),
{fit_ctes("q", "drows_train", "dohe_train", OHE_FIT["iterations"], OHE_FIT["step_size"], OHE_FIT["reg_param"])}
SELECT idx, {r6('w')} AS weight, (SELECT it FROM q_it) AS iterations FROM q_wf"""

    q["feature_counts"] = f"WITH {ohe_ctes()}\nSELECT idx, count(*)::BIGINT AS n FROM ohe_train GROUP BY idx"
    buckets = " ".join(f"WHEN n <= {2 ** e} THEN {2 ** e}" for e in range(0, 11))
    q["count_histogram"] = f"""WITH {ohe_ctes()},
fc AS (SELECT idx, count(*) AS n FROM ohe_train GROUP BY idx),
b AS (SELECT CASE {buckets} ELSE -1 END AS bucket FROM fc)
SELECT bucket::INTEGER AS bucket, count(*)::BIGINT AS n_features,
       {r6('CASE WHEN bucket > 0 THEN ln(bucket) END')} AS ln_bucket, {r6('ln(count(*))')} AS ln_count
FROM b GROUP BY bucket"""

    q["sparsity"] = f"""WITH {hash_ctes()}
SELECT 'ohe' AS features, {r6('avg(nnz)', 9)} AS avg_nnz,
       {r6('avg(nnz) / (SELECT count(*) FROM dict)', 9)} AS density
FROM (SELECT r.row_id, count(*) AS nnz FROM rows_train r JOIN cel c ON c.row_id = r.row_id
      GROUP BY r.row_id)
UNION ALL
SELECT 'hashed', {r6('avg(nnz)', 9)}, {r6(f'avg(nnz) / {BUCKETS}', 9)}
FROM (SELECT r.row_id, count(h.idx) AS nnz FROM rows_train r LEFT JOIN hash_train h
      ON h.row_id = r.row_id GROUP BY r.row_id)"""

    q["md5_buckets"] = f"""WITH {CE}
SELECT row_id, feature_id, category || feature_id::VARCHAR AS feature_string,
       {md5_bucket_sql("category || feature_id::VARCHAR", 4)} AS bucket_4,
       {md5_bucket_sql("category || feature_id::VARCHAR", 100)} AS bucket_100,
       {md5_bucket_sql("category || feature_id::VARCHAR", BUCKETS)} AS bucket_32768
FROM cel"""
    q["hash_features"] = f"WITH {hash_ctes()}\nSELECT h.row_id, c.label, h.idx, h.value FROM hlong h JOIN ce c ON c.row_id = h.row_id"
    q["hash_collisions"] = (f"WITH {hash_ctes(COLLISION_BUCKETS)}\n"
                            f"SELECT h.row_id, c.label, h.idx, h.value FROM hlong h JOIN ce c ON c.row_id = h.row_id")

    li_feats = ["l_linenumber::VARCHAR", "l_quantity::INTEGER::VARCHAR",
                "round(l_discount * 100)::INTEGER::VARCHAR", "round(l_tax * 100)::INTEGER::VARCHAR",
                "year(l_shipdate)::VARCHAR", "month(l_shipdate)::VARCHAR",
                "l_suppkey::VARCHAR", "l_partkey::VARCHAR"]
    li_strs = ", ".join(f"coalesce({f}, '') || '{i}'" for i, f in enumerate(li_feats))
    li_cols = ", ".join(f"coalesce({f}, '')" for f in li_feats)
    q["lineitem_split_sizes"] = f"""WITH li AS (
  SELECT array_to_string([CASE WHEN l_returnflag = 'R' THEN '1' ELSE '0' END, {li_cols}], '|') AS content
  FROM lineitem),
{content_split_ctes('content', 'li')}
SELECT coalesce(split, 'total') AS split, count(*)::BIGINT AS n_rows FROM parts GROUP BY ROLLUP (split)"""
    q["lineitem_categories_per_feature"] = f"""WITH li AS (
  SELECT unnest(range({len(li_feats)}))::INTEGER AS feature_id, unnest([{li_cols}]) AS category
  FROM lineitem)
SELECT feature_id, count(DISTINCT category)::BIGINT AS n_categories FROM li GROUP BY feature_id"""
    q["lineitem_hash_nnz"] = f"""WITH li AS (SELECT list_distinct([{li_strs}]) AS strs FROM lineitem),
per_row AS (
  SELECT len(list_distinct(list_transform(strs, lambda s: {md5_bucket_sql('s', 1024)})))::INTEGER AS nnz,
         len(strs)::DOUBLE AS total
  FROM li)
SELECT nnz, {r6('total')} AS total, count(*)::BIGINT AS n_rows FROM per_row GROUP BY nnz, total"""

    q["dot_products"] = f"""WITH j AS (
  SELECT a.vec_id, a.embedding AS x, b.embedding AS y
  FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1)
SELECT vec_id,
  {r6('list_sum(list_transform(range(1, len(x) + 1), lambda i: x[i]::DOUBLE * y[i]::DOUBLE))')} AS dense_dot,
  {r6('coalesce(list_sum(list_transform(list_filter(range(1, len(x) + 1), lambda i: abs(x[i]::DOUBLE) > 0.0::DOUBLE), lambda i: x[i]::DOUBLE * y[i]::DOUBLE)), 0.0)')} AS sparse_dot,
  len(list_filter(range(1, len(x) + 1), lambda i: abs(x[i]::DOUBLE) > 0.0::DOUBLE))::INTEGER AS nnz
FROM j"""

    q["log_loss_scalar"] = f"""WITH e AS (
  SELECT event_id AS row_id, user_id, hour(ts) AS h,
         CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS label FROM events),
p AS (SELECT row_id, label, avg(label::DOUBLE) OVER (PARTITION BY user_id, h) AS p FROM e)
SELECT row_id, {r6('p')} AS p, label::INTEGER AS label, {r6(log_loss_sql('p', 'label'))} AS log_loss FROM p"""

    q["base_rate"] = f"WITH {CE}\nSELECT {r6('avg(label)')} AS base_rate FROM ces WHERE split = 'train'"
    rate = "(SELECT avg(label) FROM ces WHERE split = 'train')"
    q["baseline_log_loss"] = f"""WITH {CE}
SELECT split, {r6(f'avg({log_loss_sql(rate, "label")})')} AS log_loss FROM ces GROUP BY split"""

    q["ohe_fit"] = (f"WITH {ohe_fit()}\nSELECT idx, {r6('w')} AS weight, "
                    f"(SELECT it FROM f_it) AS iterations FROM f_wf")
    q["smallest_weights"] = (f"WITH {ohe_fit()}\nSELECT idx, {r6('w')} AS weight FROM f_wf "
                             f"WHERE idx >= 0 ORDER BY round(w, 6), idx LIMIT 5")
    q["predict_scores"] = (f"WITH {ohe_fit()},\n{predict_cte('pv', 'f', 'rows_validation', 'ohe_validation')}\n"
                           f"SELECT row_id, label, {r6('score')} AS score FROM pv")
    q["predict_scores_shuffled"] = q["predict_scores"]
    evals = []
    for s in ("train", "validation", "test"):
        evals.append(predict_cte(f"p_{s}", "f", f"rows_{s}", f"ohe_{s}"))
    union = " UNION ALL ".join(
        f"SELECT '{s}' AS split, avg({log_loss_sql('score', 'label')}) AS ll FROM p_{s}"
        for s in ("train", "validation", "test"))
    q["evaluate_log_loss"] = (f"WITH {ohe_fit()},\n" + ",\n".join(evals) +
                              f"\nSELECT split, {r6('ll')} AS log_loss FROM ({union})")
    q["roc_curve"] = f"""WITH {ohe_fit()},
{predict_cte('pv', 'f', 'rows_validation', 'ohe_validation')},
pts AS (SELECT round(score, 9) AS score, sum(label) AS pos, sum(1.0 - label) AS neg FROM pv GROUP BY 1),
cum AS (
  SELECT score, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
         sum(pos) OVER () AS tpos, sum(neg) OVER () AS tneg
  FROM pts WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT score + 0.0 AS score, tp::BIGINT AS tp, fp::BIGINT AS fp,
       {r6('CASE WHEN tpos = 0 THEN NULL ELSE tp / tpos END', 9)} AS tpr,
       {r6('CASE WHEN tneg = 0 THEN NULL ELSE fp / tneg END', 9)} AS fpr
FROM cum"""

    q["roc_curve_ranged"] = q["roc_curve"]
    q["roc_curve_binned"] = f"""WITH {ohe_fit()},
{predict_cte('pv', 'f', 'rows_validation', 'ohe_validation')},
pts AS (SELECT floor(score * 20) / 20.0 AS score, sum(label) AS pos, sum(1.0 - label) AS neg
        FROM pv GROUP BY 1),
cum AS (
  SELECT score, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
         sum(pos) OVER () AS tpos, sum(neg) OVER () AS tneg
  FROM pts WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT {r6('score', 9)} AS score, tp::BIGINT AS tp, fp::BIGINT AS fp,
       {r6('CASE WHEN tpos = 0 THEN NULL ELSE tp / tpos END', 9)} AS tpr,
       {r6('CASE WHEN tneg = 0 THEN NULL ELSE fp / tneg END', 9)} AS fpr
FROM cum"""

    # one-hot report
    rep_rows = [
        ("train", "baseline", "base_rate", rate),
        ("train", "baseline", "log_loss",
         f"(SELECT avg({log_loss_sql(rate, 'label')}) FROM rows_train)"),
        ("train", "logreg", "log_loss",
         f"(SELECT avg({log_loss_sql('score', 'label')}) FROM p_train)"),
        ("validation", "baseline", "log_loss",
         f"(SELECT avg({log_loss_sql(rate, 'label')}) FROM rows_validation)"),
        ("validation", "logreg", "log_loss",
         f"(SELECT avg({log_loss_sql('score', 'label')}) FROM p_validation)"),
        ("train", "none", "avg_nnz",
         "(SELECT avg(c)::DOUBLE FROM (SELECT count(*) AS c FROM ohe_train GROUP BY row_id))"),
        ("train", "none", "density",
         "(SELECT avg(c)::DOUBLE / (SELECT count(*) FROM dict) FROM "
         "(SELECT count(*) AS c FROM ohe_train GROUP BY row_id))"),
    ]
    sel = " UNION ALL ".join(
        f"SELECT '{s}' AS split, 'ohe' AS features, '{m}' AS model, '{met}' AS metric, ({v})::DOUBLE AS v"
        for s, m, met, v in rep_rows)
    q["metric_report"] = (f"WITH {ohe_fit()},\n{evals[0]},\n{evals[1]}\n"
                          f"SELECT split, features, model, metric, {r6('v')} AS value, "
                          f"CASE WHEN metric IN ('avg_nnz', 'density') THEN printf('%.7e', v) "
                          f"ELSE printf('%.3f', v) END AS text FROM ({sel})")

    # hashed grid
    configs = [(s, r) for s in GRID_STEPS for r in GRID_REGS]
    grid_parts = [hash_ctes(), grid_ctes("rows_train", "hash_train", configs, GRID_ITERATIONS),
                  grid_predict("gp", "rows_validation", "hash_validation")]
    grid_parts.append(f"""cells AS (
  SELECT cfg.g AS grid_pos, cfg.step AS step_size, cfg.reg AS reg_param,
         (SELECT max(i) FROM gf WHERE gf.g = cfg.g) AS iterations,
         (SELECT avg({log_loss_sql('score', 'label')}) FROM gp WHERE gp.g = cfg.g) AS ll
  FROM cfg)""")
    grid_parts.append("best AS (SELECT grid_pos FROM cells ORDER BY ll, grid_pos LIMIT 1)")
    grid_with = "WITH RECURSIVE " + ",\n".join(grid_parts)
    q["grid_search"] = (f"{grid_with}\nSELECT grid_pos::INTEGER AS grid_pos, step_size, reg_param, "
                        f"{r6('ll')} AS log_loss, iterations::INTEGER AS iterations, "
                        f"grid_pos = (SELECT grid_pos FROM best) AS is_best FROM cells")
    pivots = ", ".join(
        f"{r6(f'max(CASE WHEN reg_param = {float(r)!r}::DOUBLE THEN ll END)')} AS \"reg_{r:.0e}\""
        for r in GRID_REGS)
    q["grid_pivot"] = f"{grid_with}\nSELECT step_size, {pivots} FROM cells GROUP BY step_size"
    q["final_report"] = (
        f"{grid_with},\n{grid_predict('tp', 'rows_test', 'hash_test')}" + f""",
fr AS (
  SELECT 'test' AS split, 'hashed' AS features, 'baseline' AS model, 'log_loss' AS metric,
         (SELECT avg({log_loss_sql(rate, 'label')}) FROM rows_test)::DOUBLE AS v
  UNION ALL
  SELECT 'test', 'hashed', 'logreg', 'log_loss',
         (SELECT avg({log_loss_sql('score', 'label')}) FROM tp
          WHERE tp.g = (SELECT grid_pos FROM best))::DOUBLE)
SELECT split, features, model, metric, {r6('v')} AS value, printf('%.3f', v) AS text FROM fr""")
    cell = ("'step=' || step_size::VARCHAR || ', reg=' || CASE reg_param "
            + " ".join(f"WHEN {float(r)!r}::DOUBLE THEN '{float(r)!r}'" for r in GRID_REGS) + " END")
    q["hashed_report"] = (
        f"{grid_with},\n{grid_predict('tp', 'rows_test', 'hash_test')}" + f""",
hr AS (
  SELECT 'validation' AS split, {cell} AS model, ll::DOUBLE AS v,
         printf('stepSize = %.1f, regParam = %.0e: logloss = %.3f', step_size, reg_param, ll) AS line FROM cells
  UNION ALL
  SELECT 'validation', 'logreg', ll::DOUBLE, NULL FROM cells WHERE grid_pos = (SELECT grid_pos FROM best)
  UNION ALL
  SELECT 'validation', 'baseline', (SELECT avg({log_loss_sql(rate, 'label')}) FROM rows_validation)::DOUBLE, NULL
  UNION ALL
  SELECT 'test', 'baseline', (SELECT avg({log_loss_sql(rate, 'label')}) FROM rows_test)::DOUBLE, NULL
  UNION ALL
  SELECT 'test', 'logreg', (SELECT avg({log_loss_sql('score', 'label')}) FROM tp
                            WHERE tp.g = (SELECT grid_pos FROM best))::DOUBLE, NULL)
SELECT split, 'hashed' AS features, model, 'log_loss' AS metric, {r6('v')} AS value,
       coalesce(line, printf('%.3f', v)) AS text FROM hr""")
    q["sparse_vectors"] = f"""WITH {ohe_ctes()}
SELECT row_id, label, (SELECT count(*)::INTEGER FROM dict) AS size, idx, value FROM ohe_validation"""
    q["ohe_fit_ranged"] = q["ohe_fit"]
    q["predict_scores_ranged"] = q["predict_scores"]
    q["text_offsets"] = f"""WITH {CE}
SELECT count(*)::BIGINT AS n_lines, count(*)::BIGINT AS n_offsets, sum(strlen(line) + 1)::BIGINT AS n_bytes
FROM (SELECT concat_ws({TAB}, label::INTEGER::VARCHAR, f0, f1, f2, f3, f4) AS line FROM ce)"""
    q["roc_ranges"] = """SELECT count(DISTINCT l_extendedprice)::BIGINT AS n_points, TRUE AS even FROM lineitem"""
    return {k: v for k, v in q.items() if v is not None}


ORACLE_SQL = _sql()
