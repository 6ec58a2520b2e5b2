"""Independent DuckDB SQL for every catalogue query (the correctness oracle).

The oracle deliberately does not share the Spark plans: trailing windows are
plain self-joins, sampling draws are recomputed from md5, metrics are written
from their textbook definitions. Doubles are rounded to 6 digits on both sides.
"""

from __future__ import annotations

SECONDS_PER_DAY = 86400

TX = """tx AS (
  SELECT event_id AS id,
         floor(epoch(ts))::BIGINT AS dt,
         value AS amt,
         user_id AS card1,
         json_extract_string(props, '$.k')::INT AS card2,
         CASE WHEN json_extract_string(props, '$.k')::INT % 10 = 0 THEN NULL
              ELSE json_extract_string(props, '$.k')::INT % 10 END AS addr1,
         event_type AS product,
         (event_type = 'error')::INT AS y,
         value / 500.0 AS score
  FROM events)"""

TIED_ORDERS = """tied AS (
  SELECT o_orderkey AS id, floor(epoch(o_orderdate))::BIGINT AS dt,
         o_totalprice AS amt, o_custkey AS cust
  FROM orders)"""


def rolling_select(src: str, key: str, days, id_col="id", dt="dt", amt="amt",
                   vname="amt", iname="id") -> str:
    """Self-join form of the trailing window for one key: rows of the same key
    with dt >= t - W ordered strictly before the row by (dt, id)."""
    maxw = max(days) * SECONDS_PER_DAY
    cols = []
    for d in sorted(days):
        w = d * SECONDS_PER_DAY
        inw = f"b.{dt} >= a.{dt} - {w}"
        cols += [
            f"round(coalesce(avg(CASE WHEN {inw} THEN b.{amt} END), 0), 6) AS {key}_{vname}_mean_{d}d",
            f"round(coalesce(stddev_pop(CASE WHEN {inw} THEN b.{amt} END), 0), 6) AS {key}_{vname}_std_{d}d",
            f"round(coalesce(min(CASE WHEN {inw} THEN b.{amt} END), 0), 6) AS {key}_{vname}_min_{d}d",
            f"round(coalesce(max(CASE WHEN {inw} THEN b.{amt} END), 0), 6) AS {key}_{vname}_max_{d}d",
            f"count(CASE WHEN {inw} THEN b.{id_col} END) AS {key}_{iname}_count_{d}d",
        ]
    return (f"SELECT a.{id_col} AS {id_col}, " + ", ".join(cols) +
            f" FROM {src} a LEFT JOIN {src} b ON a.{key} = b.{key}"
            f" AND b.{dt} >= a.{dt} - {maxw}"
            f" AND (b.{dt} < a.{dt} OR (b.{dt} = a.{dt} AND b.{id_col} < a.{id_col}))"
            f" GROUP BY a.{id_col}")


def rolling_multi(src_cte: str, src: str, keys, days, **kw) -> str:
    parts = [f"r{i} AS ({rolling_select(src, k, days, **kw)})" for i, k in enumerate(keys)]
    sel = ["r0.id"]
    for i, k in enumerate(keys):
        for d in sorted(days):
            for f in ("mean", "std", "min", "max"):
                sel.append(f"r{i}.{k}_amt_{f}_{d}d")
            sel.append(f"r{i}.{k}_id_count_{d}d")
    joins = " ".join(f"JOIN r{i} USING (id)" for i in range(1, len(keys)))
    return f"WITH {src_cte}, {', '.join(parts)} SELECT {', '.join(sel)} FROM r0 {joins}"


SQL: dict[str, str] = {}

SQL["rolling_user_1d_7d"] = f"WITH {TX} " + rolling_select("tx", "card1", [1, 7])
SQL["rolling_ties_orders"] = f"WITH {TIED_ORDERS} " + rolling_select("tied", "cust", [30])
# Rounded once: rounding to 6 digits first would move values next to a half.
OFFSET_TX = f"""{TX}, off AS (SELECT id, dt, card2, amt + 1e6 AS amt FROM tx)
SELECT a.id, round(coalesce(stddev_pop(b.amt), 0), 3) AS card2_amt_std_7d, count(b.id) AS card2_id_count_7d
FROM off a LEFT JOIN off b ON a.card2 = b.card2 AND b.dt >= a.dt - {7 * SECONDS_PER_DAY}
  AND (b.dt < a.dt OR (b.dt = a.dt AND b.id < a.id))
GROUP BY a.id"""
SQL["rolling_large_offset"] = f"WITH {OFFSET_TX}"
SQL["rolling_large_offset_blocks"] = f"WITH {OFFSET_TX}"
# Centred on the offset first; the stored amounts are the same doubles on both sides.
SQL["rolling_tiny_spread"] = f"""WITH {TX}, off AS (SELECT id, dt, card2, (1e9::DOUBLE + amt / 100.0) - 1e9::DOUBLE AS amt FROM tx)
SELECT a.id, round(coalesce(stddev_pop(b.amt), 0), 3) AS card2_amt_std_7d, count(b.id) AS card2_id_count_7d
FROM off a LEFT JOIN off b ON a.card2 = b.card2 AND b.dt >= a.dt - {7 * SECONDS_PER_DAY}
  AND (b.dt < a.dt OR (b.dt = a.dt AND b.id < a.id))
GROUP BY a.id"""
SQL["rolling_multi_key"] = rolling_multi(TX, "tx", ["card1", "card2", "addr1"], [1, 3, 7])

TXD = TX + """, txd AS (
  SELECT *, dt % 86400 AS seconds_of_day, amt - floor(amt) AS cents,
         floor((dt - (SELECT min(dt) FROM tx)) / 86400)::INT AS day
  FROM tx)"""

SQL["time_features"] = f"""WITH {TXD}
SELECT id, seconds_of_day, round(cents, 6) AS cents, day FROM txd"""

DOCS_JOIN = """SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""

SQL["identity_left_join"] = DOCS_JOIN

SQL["null_profile"] = f"""WITH j AS ({DOCS_JOIN})
SELECT 'doc_id' AS "column", count(*) - count(doc_id) AS nulls FROM j
UNION ALL SELECT 'lang', count(*) - count(lang) FROM j
UNION ALL SELECT 'source', count(*) - count(source) FROM j
UNION ALL SELECT 'n_chars', count(*) - count(n_chars) FROM j
UNION ALL SELECT 'quality', count(*) - count(quality) FROM j
UNION ALL SELECT 'toxic', count(*) - count(toxic) FROM j"""

SQL["impute"] = f"""WITH j AS ({DOCS_JOIN})
SELECT doc_id, coalesce(lang, 'missing') AS lang, coalesce(source, 'missing') AS source,
       coalesce(n_chars, 0) AS n_chars, coalesce(quality, 0) AS quality,
       coalesce(toxic, 0) AS toxic FROM j"""

SQL["encode_categories"] = f"""WITH {TX}, e AS (
  SELECT id, product, addr1::VARCHAR AS addr1, card2::VARCHAR AS card2 FROM tx)
SELECT id,
  (dense_rank() OVER (ORDER BY product) - 1)::INT AS product,
  (dense_rank() OVER (ORDER BY addr1 ASC NULLS LAST) - 1)::INT AS addr1,
  (dense_rank() OVER (ORDER BY coalesce(card2, 'missing')) - 1)::INT AS card2
FROM e"""

SQL["split_profile"] = f"""WITH {TXD}
SELECT CASE WHEN day < 14 THEN 'train' ELSE 'test' END AS side, count(*) AS rows,
       round(avg(y), 6) AS positive_rate, min(day) AS first_day, max(day) AS last_day
FROM txd GROUP BY 1"""


def _manifest(src: str, width: int) -> str:
    return f"""SELECT batch_id, (f + batch_id * {width})::INT AS start_day,
       (f + batch_id * {width} + {width - 1})::INT AS end_day, count(*) AS size,
       round(avg(y), 6) AS positive_rate
FROM (SELECT *, floor((day - f) / {width})::INT AS batch_id
      FROM (SELECT *, min(day) OVER () AS f FROM {src}))
GROUP BY batch_id, f"""


SQL["batch_manifest_7d"] = f"WITH {TXD}, s AS (SELECT * FROM txd WHERE day >= 14) " + _manifest("s", 7)
SQL["daily_batches"] = f"WITH {TXD} " + _manifest("txd", 1)

DAILY = """SELECT day, count(id) AS TransactionCount, sum(y)::BIGINT AS FraudCount,
       avg(y) AS FraudRate, avg(amt) AS AvgTransactionAmt FROM txd GROUP BY day"""

SQL["daily_stats"] = f"""WITH {TXD}, d AS ({DAILY})
SELECT day, TransactionCount, FraudCount, round(FraudRate, 6) AS FraudRate,
       round(AvgTransactionAmt, 6) AS AvgTransactionAmt FROM d"""

SQL["daily_stats_mean"] = f"""WITH {TXD}, d AS ({DAILY})
SELECT round(avg(TransactionCount), 6) AS avg_daily_count,
       round(avg(FraudCount), 6) AS avg_daily_positives,
       round(avg(FraudRate), 6) AS avg_daily_rate,
       round((SELECT avg(y) FROM txd), 6) AS overall_rate FROM d"""

SQL["describe_by_class"] = f"""WITH {TX}
SELECT y, count(amt) AS count, round(avg(amt), 6) AS mean, round(stddev_samp(amt), 6) AS std,
       round(min(amt), 6) AS min, round(quantile_cont(amt, 0.25), 6) AS p25,
       round(quantile_cont(amt, 0.5), 6) AS p50, round(quantile_cont(amt, 0.75), 6) AS p75,
       round(max(amt), 6) AS max
FROM tx GROUP BY y"""

SQL["top_values"] = f"""WITH {TX}, s AS (
  SELECT 'product' AS "column", product::VARCHAR AS value FROM tx
  UNION ALL SELECT 'card2', card2::VARCHAR FROM tx
  UNION ALL SELECT 'addr1', addr1::VARCHAR FROM tx),
c AS (SELECT "column", value, count(*) AS cnt FROM s WHERE value IS NOT NULL GROUP BY ALL)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY cnt DESC, value ASC)::INT AS pos FROM c)
WHERE pos <= 5"""

SQL["pivot_counts"] = f"""WITH {TX}
SELECT product, count(*) FILTER (WHERE y = 0) AS n_0, count(*) FILTER (WHERE y = 1) AS n_1
FROM tx GROUP BY product"""

SQL["box_stats"] = f"""WITH {TX}, d AS (SELECT y, amt FROM tx WHERE amt < 500),
q AS (SELECT y, quantile_cont(amt, 0.25) AS q1, quantile_cont(amt, 0.5) AS median,
             quantile_cont(amt, 0.75) AS q3 FROM d GROUP BY y),
f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT d.y, round(f.q1, 6) AS q1, round(f.median, 6) AS median, round(f.q3, 6) AS q3,
       round(min(amt) FILTER (WHERE amt BETWEEN lo AND hi), 6) AS whisker_low,
       round(max(amt) FILTER (WHERE amt BETWEEN lo AND hi), 6) AS whisker_high,
       count(*) FILTER (WHERE NOT (amt BETWEEN lo AND hi)) AS outliers, count(*) AS n
FROM d JOIN f ON d.y = f.y GROUP BY d.y, f.q1, f.median, f.q3"""

SQL["dataset_summary"] = f"""WITH {TXD}
SELECT 12 AS columns, 11 AS features, count(*) AS rows, sum(y)::BIGINT AS positives,
       (count(*) - sum(y))::BIGINT AS negatives, round(avg(y), 6) AS positive_rate,
       max(day) AS last_day, max(day) - min(day) + 1 AS span_days,
       round((max(day) - min(day) + 1) / 30.0, 6) AS span_months
FROM txd"""

SQL["duplicate_keys"] = """SELECT o_custkey, o_orderdate::DATE AS o_orderdate, count(*) AS n
FROM orders GROUP BY 1, 2 HAVING count(*) > 1"""

# ------------------------------------------------------------------ metrics
from txrisk.functions.thresholds import THRESHOLDS  # noqa: E402

GRID = "grid(threshold) AS (VALUES " + ", ".join(f"('{t!r}'::DOUBLE)" for t in THRESHOLDS) + ")"

TX_SCORED = TX + ", sc AS (SELECT id, y, score, (score >= 0.5)::INT AS pred FROM tx)"


def labelled(label: str) -> str:
    return f"""sc AS (SELECT l.doc_id AS id, l.{label}::INT AS y,
        least(d.n_chars, 5000) / 5000.0 AS score,
        (least(d.n_chars, 5000) / 5000.0 >= 0.5)::INT AS pred
      FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""


AUC = """(SELECT CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN
           sum(pos * (below + neg / 2.0)) / (sum(pos)::DOUBLE * sum(neg)) END
  FROM (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
        FROM (SELECT score AS s, sum(y) AS pos, sum(1 - y) AS neg FROM {src} GROUP BY score)))"""

CONF = """(SELECT sum(CASE WHEN y = 1 AND pred = 1 THEN 1 ELSE 0 END)::BIGINT AS tp,
          sum(CASE WHEN y = 0 AND pred = 1 THEN 1 ELSE 0 END)::BIGINT AS fp,
          sum(CASE WHEN y = 1 AND pred = 0 THEN 1 ELSE 0 END)::BIGINT AS fn,
          sum(CASE WHEN y = 0 AND pred = 0 THEN 1 ELSE 0 END)::BIGINT AS tn FROM {src})"""

PRF = """round(coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1,
       round(coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0), 6) AS precision,
       round(coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0), 6) AS recall"""

SQL["roc_auc"] = f"WITH {TX_SCORED} SELECT round({AUC.format(src='sc')}, 6) AS auc"
SQL["roc_auc_labels"] = (f"WITH {labelled('quality')}, q AS (SELECT * FROM sc), "
                         f"{labelled('toxic').replace('sc AS', 'tq AS')} "
                         f"SELECT round({AUC.format(src='q')}, 6) AS auc_quality, "
                         f"round({AUC.format(src='tq')}, 6) AS auc_toxic")

HARD = """(SELECT coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0) * coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0)
         + (1 - coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0)) * ((tp + fn)::DOUBLE / (tp + fp + fn + tn))
  FROM {conf})"""

SQL["auc_pr_hard"] = f"WITH {TX_SCORED} SELECT round({HARD.format(conf=CONF.format(src='sc'))}, 6) AS auc_pr_hard"

AP = """(SELECT CASE WHEN sum(pos) > 0 THEN sum(pos * cp / cn) / sum(pos) END FROM (
   SELECT pos, sum(pos) OVER (ORDER BY s DESC) AS cp, sum(pos + neg) OVER (ORDER BY s DESC) AS cn
   FROM (SELECT score AS s, sum(y) AS pos, sum(1 - y) AS neg FROM {src} GROUP BY score)))"""

SQL["average_precision"] = f"WITH {labelled('toxic')} SELECT round({AP.format(src='sc')}, 6) AS average_precision"

SQL["confusion_metrics"] = f"WITH {TX_SCORED} SELECT tp, fp, fn, tn, {PRF} FROM {CONF.format(src='sc')}"

SQL["evaluate_labels"] = (f"WITH {labelled('quality')} SELECT round({AUC.format(src='sc')}, 6) AS auc, "
                          f"round({HARD.format(conf=CONF.format(src='sc'))}, 6) AS auc_pr_hard, "
                          f"round({AP.format(src='sc')}, 6) AS average_precision, {PRF} "
                          f"FROM {CONF.format(src='sc')}")

SWEEP = """sweep AS (
  SELECT threshold, tp, fp, fn FROM (
    SELECT g.threshold,
           sum(CASE WHEN s.score >= g.threshold AND s.y = 1 THEN 1 ELSE 0 END) AS tp,
           sum(CASE WHEN s.score >= g.threshold AND s.y = 0 THEN 1 ELSE 0 END) AS fp,
           sum(CASE WHEN s.score < g.threshold AND s.y = 1 THEN 1 ELSE 0 END) AS fn,
           count(*) AS n
    FROM grid g CROSS JOIN sc s GROUP BY g.threshold)
  WHERE tp + fp > 0 AND tp + fp < n)"""

SWEEP_COLS = f"round(threshold, 6) AS threshold, {PRF}"

SQL["threshold_sweep"] = f"WITH {TX_SCORED}, {GRID}, {SWEEP} SELECT {SWEEP_COLS} FROM sweep"
SQL["best_threshold"] = (f"WITH {labelled('toxic')}, {GRID}, {SWEEP}, m AS (SELECT threshold, "
                         "coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1v, * EXCLUDE (threshold) FROM sweep) "
                         f"SELECT {SWEEP_COLS}, round(f1v, 6) AS score FROM m ORDER BY f1v DESC, threshold ASC LIMIT 1")
for _metric, _value in (("precision", "coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0)"),
                        ("recall", "coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0)")):
    SQL[f"best_threshold_{_metric}"] = (
        f"WITH {TX_SCORED}, {GRID}, {SWEEP}, m AS (SELECT threshold, {_value} AS v, * EXCLUDE (threshold) FROM sweep) "
        f"SELECT {SWEEP_COLS}, round(v, 6) AS score FROM m ORDER BY v DESC, threshold ASC LIMIT 1")
SQL["threshold_top10"] = (f"WITH {TX_SCORED}, {GRID}, {SWEEP} SELECT {SWEEP_COLS} FROM sweep "
                          "ORDER BY coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0) DESC, threshold ASC LIMIT 10")

SQL["metrics_at_threshold"] = (f"WITH {TX}, sc AS (SELECT id, y, score, (score >= 0.3)::INT AS pred FROM tx) "
                               f"SELECT 0.3::DOUBLE AS threshold, round({AUC.format(src='sc')}, 6) AS auc, {PRF} "
                               f"FROM {CONF.format(src='sc')}")

SQL["batch_error_rate"] = f"""WITH {TXD}, b AS (
  SELECT floor((day - (SELECT min(day) FROM txd)) / 7)::INT AS batch_id, y, (score >= 0.5)::INT AS pred FROM txd)
SELECT batch_id, round(avg((pred <> y)::INT), 6) AS error_rate, count(*) AS size FROM b GROUP BY batch_id"""

# ------------------------------------------------------------------ sampling / kNN


def md5draw(expr: str, stream: str = "") -> str:
    suffix = f"|42|{stream}" if stream else "|42"
    return f"('0x' || substr(md5({expr}::VARCHAR || '{suffix}'), 1, 8))::BIGINT"


SQL["undersample"] = f"""WITH {TX},
d AS (SELECT id, y, {md5draw('id')} AS dr FROM tx),
r AS (SELECT id, y, row_number() OVER (PARTITION BY y ORDER BY dr, id) AS rn FROM d)
SELECT id, y FROM r WHERE rn <= (SELECT min(n) FROM (SELECT count(*) AS n FROM tx GROUP BY y))"""

SQL["oversample"] = f"""WITH {TX},
c AS (SELECT y, count(*) AS n FROM tx GROUP BY y),
mi AS (SELECT y, n FROM c ORDER BY n, y LIMIT 1),
need AS (SELECT max(n) - min(n) AS n FROM c),
mino AS (SELECT id, y, row_number() OVER (ORDER BY id) - 1 AS idx FROM tx WHERE y = (SELECT y FROM mi)),
picks AS (SELECT i AS copy_no, {md5draw('i', 'over')} % (SELECT n FROM mi) AS idx
          FROM (SELECT unnest(range((SELECT n FROM need))) AS i))
SELECT id, y, NULL::BIGINT AS copy_no FROM tx
UNION ALL SELECT m.id, m.y, p.copy_no FROM picks p JOIN mino m ON p.idx = m.idx"""


def knn_sql(src: str, k: int, partition: str = "") -> str:
    on = "a.id <> b.id" + (f" AND a.{partition} = b.{partition}" if partition else "")
    return f"""(SELECT id, nn_rank, nn_id, distance FROM (
  SELECT a.id, b.id AS nn_id, list_distance(a.vec, b.vec) AS distance,
         row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.vec, b.vec), b.id)::INT AS nn_rank
  FROM {src} a JOIN {src} b ON {on}) WHERE nn_rank <= {k})"""


VEC = "v AS (SELECT vec_id AS id, label, (label = 0)::INT AS y, embedding::DOUBLE[] AS vec FROM embeddings)"

SQL["knn5"] = (f"WITH {VEC} "
               f"SELECT id, nn_rank, nn_id, round(distance, 6) AS distance FROM {knn_sql('v', 5)}")
SQL["knn3_by_label"] = (f"WITH {VEC} SELECT id, nn_rank, nn_id, round(distance, 6) AS distance "
                        f"FROM {knn_sql('v', 3, 'label')}")

SMOTE = f"""{VEC},
c AS (SELECT y, count(*) AS n FROM v GROUP BY y),
mi AS (SELECT y, n FROM c ORDER BY n, y LIMIT 1),
need AS (SELECT max(n) - min(n) AS n FROM c),
mino AS (SELECT id, vec, row_number() OVER (ORDER BY id) - 1 AS idx FROM v WHERE y = (SELECT y FROM mi)),
nn AS {knn_sql('mino', 5)},
picks AS (SELECT i, {md5draw('i', 'base')} % (SELECT n FROM mi) AS idx,
                 ({md5draw('i', 'nn')} % 5 + 1)::INT AS nn_rank,
                 {md5draw('i', 'step')} / 4294967296.0::DOUBLE AS u
          FROM (SELECT unnest(range((SELECT n FROM need))) AS i)),
syn AS (SELECT -(p.i + 1) AS id, (SELECT y FROM mi) AS y, b.id AS base_id, nn.nn_id, p.u,
               list_transform(list_zip(b.vec, nv.vec), lambda z: z[1] + p.u * (z[2] - z[1])) AS vec
        FROM picks p JOIN mino b ON p.idx = b.idx
        JOIN nn ON nn.id = b.id AND nn.nn_rank = p.nn_rank
        JOIN mino nv ON nv.id = nn.nn_id)"""

SQL["smote"] = f"""WITH {SMOTE}
SELECT id, base_id, nn_id, round(u, 6) AS u, round(vec[1], 6) AS x0, round(list_sum(vec), 6) AS xsum FROM syn"""

SQL["smoteenn"] = f"""WITH {SMOTE},
allv AS (SELECT id, y, vec FROM v UNION ALL SELECT id, y, vec FROM syn),
nb AS {knn_sql('allv', 3)},
bad AS (SELECT nb.id, sum((a.y <> b.y)::INT) AS nbad FROM nb JOIN allv a ON a.id = nb.id
        JOIN allv b ON b.id = nb.nn_id GROUP BY nb.id)
SELECT a.id, a.y FROM allv a JOIN bad ON a.id = bad.id WHERE bad.nbad = 0"""

# ------------------------------------------------------------------ drift
ERROR_SERIES = """s AS (SELECT product AS series, floor(dt / 21600)::BIGINT AS pos,
             avg(((score >= 0.5)::INT <> y)::DOUBLE) AS value FROM tx GROUP BY ALL)"""


def first_detection_sql(src: str, delta: float = 0.002) -> str:
    """Every cut of every prefix of each series (CTE list after ``src``, then the select)."""
    return f"""p AS (SELECT series, pos, row_number() OVER w AS k, sum(value) OVER w AS cs, sum(value * value) OVER w AS cs2
      FROM {src} WINDOW w AS (PARTITION BY series ORDER BY pos ROWS UNBOUNDED PRECEDING)),
m AS (SELECT e.series, e.pos, c.k::DOUBLE AS n0, (e.k - c.k)::DOUBLE AS n1,
             c.cs / c.k AS mean0, (e.cs - c.cs) / (e.k - c.k) AS mean1,
             greatest(e.cs2 / e.k - (e.cs / e.k) * (e.cs / e.k), 0) AS var,
             ln(2 / ({delta} / ln(e.k))) AS lt
      FROM p e JOIN p c ON e.series = c.series AND c.k >= 5 AND e.k - c.k >= 5 AND e.k >= 10),
g AS (SELECT series, pos, max(abs(mean0 - mean1) - (sqrt(2 * (1 / n0 + 1 / n1) * var * lt)
             + 2 * (1 / n0 + 1 / n1) / 3 * lt)) AS margin FROM m GROUP BY series, pos),
f AS (SELECT series, min(pos) FILTER (WHERE margin >= 0) AS first_pos FROM g GROUP BY series),
cnt AS (SELECT series, count(*) AS n FROM {src} GROUP BY series)
SELECT cnt.series, cnt.n, f.first_pos, round(max(g.margin), 6) AS max_margin
FROM cnt JOIN f USING (series) JOIN g USING (series)
WHERE f.first_pos IS NULL OR g.pos <= f.first_pos
GROUP BY cnt.series, cnt.n, f.first_pos"""


SQL["drift_first_detection"] = f"WITH {TX}, {ERROR_SERIES}, " + first_detection_sql("s")
SQL["drift_shifted_series"] = f"""WITH {TX}, {ERROR_SERIES},
sh AS (SELECT series, pos, CASE WHEN pos >= (SELECT min(pos) + 60 FROM s) THEN 1 - value ELSE value END AS value
       FROM s), """ + first_detection_sql("sh")

# ------------------------------------------------------------------ models
ONE_FEATURE = TXD + """, one AS (SELECT id, day, (amt + card2 >= 100)::INT AS y, (card2 >= 50)::INT AS high FROM txd),
train AS (SELECT * FROM one WHERE day < 14), test AS (SELECT * FROM one WHERE day >= 14)"""

LEAF_SCORES = """SELECT id AS TransactionID, y AS isFraud, round(p, 5) AS score, (p >= 0.5)::INT AS pred
FROM test JOIN leaf USING (high)"""

SQL["rf_leaf_scores"] = f"""WITH {ONE_FEATURE},
leaf AS (SELECT high, avg(y) AS p FROM train GROUP BY high)
{LEAF_SCORES}"""

# Under-sampling keeps the smallest (draw, id) of the larger class, as many as the smaller has.
SQL["rf_undersampled_scores"] = f"""WITH {ONE_FEATURE},
ranked AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY {md5draw("id")}, id) AS r FROM train),
kept AS (SELECT * FROM ranked WHERE r <= (SELECT min(n) FROM (SELECT count(*) AS n FROM train GROUP BY y))),
leaf AS (SELECT high, avg(y) AS p FROM kept GROUP BY high)
{LEAF_SCORES}"""

# Boosting by hand: the first tree fits the signed label, each later one the gradient of the
# logistic loss, at the learning rate; a leaf holds the mean of its rows.
SQL["gbt_leaf_scores"] = f"""WITH RECURSIVE {ONE_FEATURE},
share AS (SELECT high, avg(y) AS q FROM train GROUP BY high),
boost(high, q, k, f) AS (
  SELECT high, q, 1, 2 * q - 1 FROM share
  UNION ALL
  SELECT high, q, k + 1, f + 0.3::DOUBLE * (4 * q / (1 + exp(2 * f)) - 4 * (1 - q) / (1 + exp(-2 * f)))
  FROM boost WHERE k < 100),
leaf AS (SELECT high, 1 / (1 + exp(-2 * f)) AS p FROM boost WHERE k = 100)
{LEAF_SCORES}"""

# ------------------------------------------------------------------ storage
TXR = TX + """, txr AS (SELECT id AS TransactionID, y AS isFraud, dt AS TransactionDT,
  amt AS TransactionAmt, product AS ProductCD, card1, card2, addr1 FROM tx)"""

SQL["feature_store_roundtrip"] = f"WITH {TXR} " + rolling_select(
    "txr", "card1", [1], id_col="TransactionID", dt="TransactionDT", amt="TransactionAmt",
    vname="TransactionAmt", iname="TransactionID")

SQL["typed_csv_scan"] = f"""WITH {TXR}
SELECT TransactionID, isFraud, TransactionDT, TransactionAmt, ProductCD, card1::INT AS card1,
       card2::DOUBLE AS card2, addr1::DOUBLE AS addr1 FROM txr"""

# ------------------------------------------------------------------ streaming
SQL["stream_daily_counts"] = f"""WITH {TXD}
SELECT day::BIGINT AS day, count(*) AS n, sum(y)::BIGINT AS positives FROM txd GROUP BY 1"""

STREAM_SIDE = TXD + """, st AS (SELECT *, floor((day - (SELECT min(day) FROM txd WHERE day >= 14)) / 7)::INT AS batch_id
  FROM txd WHERE day >= 14)"""

SQL["stream_prequential_rule"] = f"""WITH {STREAM_SIDE}
SELECT id, batch_id, y, round(amt / 500.0, 6) AS score, (amt / 500.0 >= 0.5)::INT AS pred FROM st"""

SQL["stream_batch_log"] = f"""WITH {STREAM_SIDE}
SELECT batch_id, (14 + batch_id * 7)::INT AS start_day, (14 + batch_id * 7 + 6)::INT AS end_day,
       count(*) AS size, round(avg(((amt / 500.0 >= 0.5)::INT <> y)::INT), 6) AS error_rate,
       false AS drift, false AS retrained
FROM st GROUP BY batch_id"""

REPLAYED = STREAM_SIDE + ", sc AS (SELECT id, batch_id, y, score, (score >= 0.5)::INT AS pred FROM st)"

SQL["stream_evaluate"] = (f"WITH {REPLAYED} SELECT round({AUC.format(src='sc')}, 6) AS auc, "
                          f"round({HARD.format(conf=CONF.format(src='sc'))}, 6) AS auc_pr, {PRF} "
                          f"FROM {CONF.format(src='sc')}")

SQL["stream_statistics"] = f"""WITH {REPLAYED}, n AS (SELECT count(DISTINCT batch_id) AS batches, count(*) AS rows FROM sc)
SELECT rows::BIGINT AS total_predictions, batches::BIGINT AS total_batches, 0::BIGINT AS retrain_count,
       0::BIGINT AS drift_count, 2 AS window_size, least(2, batches) AS current_window_batches, 0 AS warning_count
FROM n"""

SQL["stream_recovered_log"] = f"""WITH {REPLAYED}
SELECT batch_id, row_number() OVER (ORDER BY batch_id)::INT AS seq, count(*) AS size,
       round(avg((pred <> y)::INT), 6) AS error_rate, count(*) AS scored, count(DISTINCT id) AS scored_ids,
       1::BIGINT AS logged_before, round({AUC.format(src='sc')}, 6) AS auc
FROM sc GROUP BY batch_id"""

SQL["stream_no_detection_log"] = f"""WITH {TXD}
SELECT (day - 7)::INT AS batch_id, count(*) AS size,
       round(avg(((amt >= 250)::INT <> (CASE WHEN day < 18 THEN (amt >= 250)::INT ELSE 1 - (amt >= 250)::INT END))::INT), 6) AS error_rate,
       false AS drift, false AS retrained, 'rule' AS model
FROM txd WHERE day >= 7 GROUP BY day"""

SQL["stream_retrain_log"] = f"""WITH {TXD},
b AS (SELECT day - 7 AS batch_id, day AS start_day, count(*) AS size,
             avg(((amt >= 250)::INT <> (CASE WHEN day < 18 THEN (amt >= 250)::INT ELSE 1 - (amt >= 250)::INT END))::DOUBLE) AS value
      FROM txd WHERE day >= 7 GROUP BY day),
s AS (SELECT 'all' AS series, batch_id AS pos, value FROM b),
fd AS (WITH {first_detection_sql("s", 0.3)}),
d AS (SELECT b.*, coalesce(b.batch_id = (SELECT first_pos FROM fd), false) AS drift FROM b)
SELECT batch_id::INT AS batch_id, start_day::INT AS start_day, size, round(value, 6) AS error_rate,
       drift, drift AS retrained,
       concat_ws(',', lag(batch_id) OVER (ORDER BY batch_id)::INT::VARCHAR, batch_id::INT::VARCHAR) AS window_batches,
       sum(size) OVER ()::BIGINT AS total_predictions, count(*) OVER () AS total_batches,
       sum(drift::INT) OVER ()::BIGINT AS retrain_count, sum(drift::INT) OVER ()::BIGINT AS drift_count
FROM d"""

SQL["static_grid"] = """WITH g(exp_id, exp_name, windows) AS (VALUES
  ('baseline', 'Baseline (No Window Features)', 'None'), ('e1', '1-day Window', '1'),
  ('e1a', '2-day Window', '2'), ('e2', '3-day Window', '3'), ('e2a', '5-day Window', '5'),
  ('e3', '7-day Window', '7'), ('e4', '14-day Window', '14'), ('e5', '30-day Window', '30'),
  ('e6', '1+3+7-day Windows', '1+3+7'), ('e6b', '1+14-day Windows', '1+14'),
  ('e7', '1+2-day Windows', '1+2'), ('e8', '1+2+3-day Windows', '1+2+3'))
SELECT exp_id, exp_name, windows, 'xgb' AS model_type, 'undersample' AS sampling_type, 'static' AS mode,
       'ok' AS status, true AS scored, true AS in_summary
FROM g WHERE (SELECT count(*) FROM events) > 0"""

SQL["training_window_union"] = f"""WITH {STREAM_SIDE},
r AS (SELECT batch_id, dense_rank() OVER (ORDER BY batch_id DESC) AS rk FROM (SELECT DISTINCT batch_id FROM st WHERE batch_id <= 2))
SELECT id, batch_id, day, y FROM st WHERE batch_id IN (SELECT batch_id FROM r WHERE rk <= 2)"""

SQL["ranks_with_nan"] = f"""WITH {TX}, v AS (
  SELECT product, CASE WHEN card2 = 7 THEN 'nan'::DOUBLE WHEN card2 < 90 THEN 25.0 ELSE amt END AS v FROM tx),
r AS (SELECT product, v, row_number() OVER (PARTITION BY product ORDER BY v) - 1 AS rank,
             count(*) OVER (PARTITION BY product) AS n FROM v),
t AS (SELECT DISTINCT product, (n - 1) * i // 20 AS want
      FROM (SELECT product, count(*) AS n FROM v GROUP BY product), range(21) AS g(i))
SELECT r.product, rank, isnan(v) AS is_nan, CASE WHEN isnan(v) THEN NULL ELSE round(v, 6) END AS value
FROM r JOIN t ON r.product = t.product AND r.rank = t.want"""

SQL["knn5_lsh_recall"] = """SELECT count(*) AS queries, (count(*) * 5)::BIGINT AS neighbours, true AS recall_reached
FROM embeddings WHERE vec_id % 100 = 0"""


def _csv_columns_sql() -> str:
    """Cells, sum and malformed cells of every declared column, from the rules of the CSV's cells."""
    own = {"TransactionID": "id", "isFraud": "y", "TransactionDT": "dt", "TransactionAmt": "amt", "ProductCD": None,
           "card1": "card1", "card2": "card2", "addr1": "addr1"}
    names = ["TransactionID", "isFraud", "TransactionDT", "TransactionAmt", "ProductCD", "card1", "card2", "card3", "card4",
             "card5", "card6", "addr1", "addr2", "dist1", "dist2", "P_emaildomain", "R_emaildomain"]
    names += [f"{p}{i}" for p, n in (("C", 14), ("D", 15), ("M", 9), ("V", 339)) for i in range(1, n + 1)]
    text = {"ProductCD", "card4", "card6", "P_emaildomain", "R_emaildomain", *[f"M{i}" for i in range(1, 10)]}
    whole = {"TransactionID", "isFraud", "TransactionDT", "TransactionAmt", "card1"}
    parts = []
    for j, n in enumerate(names):
        if n == "ProductCD":
            cells, total, bad = "count(product)", "count(*) FILTER (product = 'T')", "false"
        elif n in text:
            cells, total, bad = f"count(*) FILTER ((id + {j}) % 3 <> 0)", f"count(*) FILTER ((id + {j}) % 3 = 1)", "false"
        else:
            bad = "false" if n in whole else f"(id + {j}) % 1009 = 0"
            value = own.get(n) or f"CASE WHEN (card2 + {j}) % 7 <> 0 THEN (card2 * {j + 1}) % 1000 + 0.5 END"
            cells, total = f"count({value}) FILTER (NOT ({bad}))", f"coalesce(sum({value}) FILTER (NOT ({bad})), 0)"
        parts.append(f"""SELECT '{n}' AS "column", {cells} AS cells, round(({total})::DOUBLE, 2) AS total,
  count(*) FILTER ({bad}) AS rejects, count(DISTINCT id) FILTER ({bad}) AS reject_rows,
  min('bad' || (id + {j})) FILTER ({bad}) AS first_reject FROM tx""")
    once = TX.replace("tx AS (", "tx AS MATERIALIZED (", 1)
    return f"WITH {once} " + " UNION ALL ".join(parts)


SQL["typed_csv_columns"] = _csv_columns_sql()

SQL["prepare_chain"] = f"""WITH {TXD}, i AS (
  SELECT id, CASE WHEN card2 % 3 <> 0 THEN -card2 END AS id_01,
         CASE WHEN card2 % 5 <> 0 THEN CASE WHEN card2 % 2 = 0 THEN 'Found' ELSE 'NotFound' END END AS id_12,
         CASE WHEN card2 % 5 <> 1 THEN CASE WHEN card2 % 2 = 0 THEN 'mobile' ELSE 'desktop' END END AS dev
  FROM tx WHERE id % 4 = 0),
j AS (SELECT t.*, i.id_01, i.id_12, i.dev FROM txd t LEFT JOIN i USING (id)),
p AS (SELECT product, row_number() OVER (ORDER BY product) - 1 AS code FROM (SELECT DISTINCT product FROM tx)),
n AS (SELECT count(DISTINCT day) AS days FROM txd)
SELECT id AS TransactionID, y AS isFraud, day AS TransactionDay, seconds_of_day AS TimeDay, cents AS Cents,
       p.code AS ProductCD, coalesce(addr1, 0)::DOUBLE AS addr1, coalesce(id_01, 0)::DOUBLE AS id_01,
       CASE id_12 WHEN 'Found' THEN 0 WHEN 'NotFound' THEN 1 ELSE 2 END AS id_12,
       CASE dev WHEN 'desktop' THEN 0 WHEN 'mobile' THEN 1 ELSE 2 END AS DeviceType,
       CASE WHEN day < 14 THEN 'train' ELSE 'test' END AS side, (days - 1) || ',0,1' AS written
FROM j JOIN p USING (product), n"""
