"""The questions SQL can express, as DuckDB text over the same tables."""

from __future__ import annotations

# The English stop words of Spark's StopWordsRemover.
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these
those am is are was were be been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there when where
why how all any both each few more most other some such no nor not only own same so than too very s
t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't
weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't
couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
""".split()

_K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER)"

_TX = f"""tx AS (
  SELECT event_id AS txn_id, CAST(user_id AS VARCHAR) AS card_id, CAST(user_id AS VARCHAR) AS member_id,
         CAST(round(value) AS INTEGER) AS amount, CAST({_K} % 25 AS VARCHAR) AS postcode,
         event_type AS pos_id, strftime(ts, '%d-%m-%Y %H:%M:%S') AS transaction_dt,
         CAST(floor(epoch(ts)) AS BIGINT) AS epoch, ts
  FROM events)"""

_CUT = "TIMESTAMP '2024-01-21 00:00:00'"
_COLS = "txn_id, card_id, member_id, amount, postcode, pos_id, transaction_dt, epoch"

_LOOKUP = f"""{_TX},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY card_id ORDER BY epoch DESC, txn_id DESC) AS rn
  FROM tx WHERE ts < {_CUT}),
stats AS (
  SELECT card_id, count(*) AS n, CAST(sum(amount) AS DOUBLE) / count(*) AS moving_avg,
         sqrt(CAST(count(*) * sum(CAST(amount AS BIGINT) * amount) - sum(amount) * sum(amount) AS DOUBLE))
           / count(*) AS moving_std,
         max(CASE WHEN rn = 1 THEN postcode END) AS postcode,
         max(CASE WHEN rn = 1 THEN transaction_dt END) AS transaction_dt,
         max(CASE WHEN rn = 1 THEN epoch END) AS epoch
  FROM ranked WHERE rn <= 10 GROUP BY card_id),
lookup AS (
  SELECT s.card_id, s.moving_avg + 3.0 * s.moving_std AS ucl, c.c_acctbal AS score,
         s.postcode, s.transaction_dt, s.epoch
  FROM stats s JOIN customer c ON s.card_id = CAST(c.c_custkey AS VARCHAR)),
zips AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS zip, 3.0::DOUBLE * n_nationkey - 36.0::DOUBLE AS lat,
         7.0::DOUBLE * n_nationkey - 90.0::DOUBLE AS lon
  FROM nation)"""


def _rad(x: str) -> str:
    return f"(({x}) * pi() / 180.0::DOUBLE)"


def _km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    cosine = (
        f"sin({_rad(lat1)}) * sin({_rad(lat2)}) + cos({_rad(lat1)}) * cos({_rad(lat2)})"
        f" * cos({_rad(f'{lon1} - {lon2}')})"
    )
    one = "1.0::DOUBLE"
    arc = f"acos(CASE WHEN {cosine} > {one} THEN {one} WHEN {cosine} < -{one} THEN -{one} ELSE {cosine} END)"
    km = f"({arc} * 180.0::DOUBLE / pi() * 60.0::DOUBLE * 1.1515::DOUBLE * 1.609344::DOUBLE)"
    return f"CAST(trunc(CAST(CAST({km} AS VARCHAR) AS DECIMAL(38,20)), 2) AS DOUBLE)"


_JOURNEYS = f"""{_LOOKUP},
journeys AS (
  SELECT t.*, l.postcode AS last_postcode, l.ucl, l.score, l.card_id IS NOT NULL AS known,
         {_km('a.lat', 'a.lon', 'b.lat', 'b.lon')} AS km,
         abs(t.epoch - l.epoch) AS secs
  FROM tx t LEFT JOIN lookup l ON t.card_id = l.card_id
  LEFT JOIN zips a ON t.postcode = a.zip LEFT JOIN zips b ON l.postcode = b.zip
  WHERE t.ts >= {_CUT})"""

_FAST = "CASE WHEN secs = 0 THEN km > 0 ELSE km / secs >= 0.25::DOUBLE END"

_FOLD = f"""{_LOOKUP},
arrivals AS (
  SELECT t.*, z.lat, z.lon, l.ucl, l.score, l.card_id IS NOT NULL AS known,
         row_number() OVER (PARTITION BY t.card_id ORDER BY t.epoch, t.txn_id) AS rn
  FROM tx t LEFT JOIN lookup l ON t.card_id = l.card_id LEFT JOIN zips z ON t.postcode = z.zip
  WHERE t.ts >= {_CUT}),
fold AS (
  SELECT c.card_id, CAST(0 AS BIGINT) AS rn, z.lat AS at_lat, z.lon AS at_lon, l.epoch AS at_epoch,
         CAST(NULL AS BIGINT) AS txn_id, CAST(NULL AS DOUBLE) AS km, CAST(NULL AS BIGINT) AS secs,
         CAST(NULL AS BOOLEAN) AS speed_rule, CAST(NULL AS BOOLEAN) AS amount_rule,
         CAST(NULL AS BOOLEAN) AS score_rule, CAST(NULL AS VARCHAR) AS status
  FROM (SELECT DISTINCT card_id FROM arrivals) c
  LEFT JOIN lookup l ON c.card_id = l.card_id LEFT JOIN zips z ON l.postcode = z.zip
  UNION ALL
  SELECT card_id, rn, CASE WHEN status = 'GENUINE' THEN lat ELSE at_lat END,
         CASE WHEN status = 'GENUINE' THEN lon ELSE at_lon END,
         CASE WHEN status = 'GENUINE' THEN epoch ELSE at_epoch END,
         txn_id, km, secs, speed_rule, amount_rule, score_rule, status
  FROM (
    SELECT *, CASE WHEN NOT known THEN 'UNKNOWN_CARD' WHEN km IS NULL THEN 'UNKNOWN_POSTCODE'
                   WHEN speed_rule OR amount_rule OR score_rule THEN 'FRAUD' ELSE 'GENUINE' END AS status
    FROM (
      SELECT *, {_FAST} AS speed_rule, amount > ucl AS amount_rule, score < 200 AS score_rule
      FROM (
        SELECT a.card_id, a.rn, a.lat, a.lon, a.epoch, a.txn_id, a.amount, a.ucl, a.score, a.known,
               f.at_lat, f.at_lon, f.at_epoch,
               {_km('f.at_lat', 'f.at_lon', 'a.lat', 'a.lon')} AS km,
               abs(a.epoch - f.at_epoch) AS secs
        FROM fold f JOIN arrivals a ON a.card_id = f.card_id AND a.rn = f.rn + 1))))"""

_DECISIONS = f"""WITH RECURSIVE {_FOLD}
SELECT a.txn_id, a.card_id, a.member_id, a.amount, a.postcode, a.pos_id, a.transaction_dt, a.epoch,
       f.km, CASE WHEN f.km IS NULL THEN NULL ELSE f.secs END AS secs,
       f.speed_rule, f.amount_rule, f.score_rule, f.status
FROM fold f JOIN arrivals a ON a.txn_id = f.txn_id"""

_CLICKS = f"""clicks AS (
  SELECT CAST(user_id AS VARCHAR) AS user_id, CAST({_K} AS VARCHAR) AS song_id FROM events
  WHERE user_id IS NOT NULL AND {_K} IS NOT NULL),
cohorts AS (SELECT CAST(vec_id AS VARCHAR) AS user_id, label AS cluster FROM embeddings)"""

_RATES = f"""cohorts AS (SELECT CAST(vec_id AS VARCHAR) AS user_id, label AS cluster FROM embeddings),
sizes AS (SELECT cluster, count(DISTINCT user_id) AS cohort_size FROM cohorts GROUP BY cluster),
notes AS (SELECT CAST({_K} AS VARCHAR) AS notification_id, CAST(user_id AS VARCHAR) AS user_id
          FROM events WHERE event_type = 'click'),
rates AS (
  SELECT c.cluster, n.notification_id, count(DISTINCT n.user_id) AS clickers,
         any_value(s.cohort_size) AS cohort_size,
         CAST(count(DISTINCT n.user_id) AS DOUBLE) / any_value(s.cohort_size) AS ctr
  FROM notes n JOIN cohorts c ON n.user_id = c.user_id JOIN sizes s ON c.cluster = s.cluster
  GROUP BY c.cluster, n.notification_id)"""

_CLEAN = """clean AS (
  SELECT doc_id AS account_id, lang AS gender, regexp_replace(text, '[^a-zA-Z0-9]', ' ', 'g') AS text1
  FROM documents
  WHERE text IS NOT NULL AND lang IS NOT NULL AND lang <> 'unknown' AND lang <> '' AND text <> '')"""

_TOKENS = f"""{_CLEAN},
tokens AS (
  SELECT account_id,
         CASE WHEN trim(text1) = '' THEN CAST([] AS VARCHAR[])
              ELSE string_split(rtrim(lower(text1), ' '), ' ') END AS words
  FROM clean)"""

_STOP = ", ".join("'" + w.replace("'", "''") + "'" for w in STOP_WORDS)

_TERMS = f"""{_TOKENS},
terms AS (
  SELECT account_id, list_filter(words, lambda w: NOT list_contains([{_STOP}], w)) AS filtered FROM tokens)"""

_METRICS = """preds AS (SELECT quality AS label, toxic AS prediction FROM labels),
total AS (SELECT count(*) AS n FROM preds),
classes AS (
  SELECT label, count(*) AS n_true, count(*) FILTER (WHERE label = prediction) AS tp
  FROM preds GROUP BY label),
said AS (SELECT prediction, count(*) AS n_said FROM preds GROUP BY prediction),
rates AS (
  SELECT n_true, tp, CASE WHEN coalesce(n_said, 0) = 0 THEN 0.0 ELSE tp / n_said END AS p, tp / n_true AS r
  FROM classes LEFT JOIN said ON prediction = label),
wide AS (
  SELECT sum(tp) / (SELECT n FROM total) AS accuracy,
         sum(n_true * p) / (SELECT n FROM total) AS weighted_precision,
         sum(n_true * r) / (SELECT n FROM total) AS weighted_recall,
         sum(n_true * CASE WHEN p + r = 0 THEN 0.0 ELSE 2 * p * r / (p + r) END) / (SELECT n FROM total) AS f1
  FROM rates)"""


def _metric(name: str, column: str) -> str:
    v = f"CAST({column} AS DOUBLE)"
    return f"SELECT '{name}' AS metric, round({v}, 6) AS value, round({v} * 100) AS percent FROM wide"


SQL = {
    "txn_parse": f"WITH {_TX} SELECT {_COLS} FROM tx WHERE pos_id <> 'error'",
    "txn_quarantine": "SELECT event_id AS txn_id, 'BAD_AMOUNT' AS reason FROM events WHERE event_type = 'error'",
    "txn_faults": """SELECT * FROM (
  SELECT event_id AS txn_id, CASE WHEN event_id % 11 = 0 THEN 'MALFORMED_JSON' WHEN event_id % 13 = 0 THEN 'MISSING_FIELD'
      WHEN event_id % 17 = 0 THEN CASE WHEN event_type = 'error' THEN 'BAD_AMOUNT' ELSE 'BAD_DATE' END
      WHEN event_id % 19 = 0 THEN 'MALFORMED_JSON' WHEN event_type = 'error' THEN 'BAD_AMOUNT' END AS reason FROM events)
WHERE reason IS NOT NULL""",
    "classified_load": f"""WITH {_TX}
SELECT CASE WHEN amount > 90 THEN 'FRAUD' ELSE 'GENUINE' END AS status, left(transaction_dt, 10) AS day, count(*) AS n,
  CAST(sum(amount) AS BIGINT) AS amount, count(DISTINCT card_id) AS cards, CAST(sum(epoch) AS BIGINT) AS epochs
FROM tx WHERE ts < {_CUT} AND txn_id % 23 <> 0 AND txn_id % 29 <> 0 AND txn_id % 31 <> 0 GROUP BY ALL""",
    "classified_quarantine": f"""WITH {_TX}
SELECT CASE WHEN txn_id % 23 = 0 THEN 'MISSING_FIELD' WHEN txn_id % 29 = 0 THEN 'BAD_AMOUNT' ELSE 'BAD_DATE' END AS reason,
  count(*) AS n
FROM tx WHERE ts < {_CUT} AND (txn_id % 23 = 0 OR txn_id % 29 = 0 OR txn_id % 31 = 0) GROUP BY ALL""",
    "zip_distance": f"""WITH {_JOURNEYS}
SELECT last_postcode, postcode, count(*) AS journeys, max(km) AS km FROM journeys GROUP BY last_postcode, postcode""",
    "txn_speed": f"""WITH {_JOURNEYS}
SELECT txn_id, card_id, km, secs, CASE WHEN secs = 0 THEN NULL ELSE round(km / secs, 6) END AS speed FROM journeys""",
    "last10_stats": f"""WITH {_TX},
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY card_id ORDER BY epoch DESC, txn_id DESC) AS rn
  FROM tx)
SELECT card_id, count(*) AS n, round(avg(amount), 4) AS moving_avg, round(stddev_pop(amount), 4) AS moving_std,
       round(avg(amount) + 3 * stddev_pop(amount), 4) AS ucl
FROM ranked WHERE rn <= 10 GROUP BY card_id""",
    "rolling10": f"""WITH {_TX}
SELECT txn_id, card_id, count(*) OVER w AS n, round(avg(amount) OVER w, 4) AS moving_avg,
       round(stddev_pop(amount) OVER w, 4) AS moving_std
FROM tx WINDOW w AS (PARTITION BY card_id ORDER BY epoch, txn_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)""",
    "latest_location": f"""WITH {_TX}
SELECT card_id, postcode, transaction_dt, epoch FROM tx
QUALIFY row_number() OVER (PARTITION BY card_id ORDER BY epoch DESC, txn_id DESC) = 1""",
    "lookup_build": f"""WITH {_LOOKUP}
SELECT card_id, round(ucl, 4) AS ucl, score, postcode, transaction_dt, epoch FROM lookup""",
    "incremental_load": f"""WITH {_TX}
SELECT card_id, postcode, transaction_dt, epoch FROM tx
QUALIFY row_number() OVER (PARTITION BY card_id ORDER BY epoch DESC, txn_id DESC) = 1""",
    "incremental_replay": f"""WITH {_LOOKUP.replace(f"FROM tx WHERE ts < {_CUT}", "FROM tx")}
SELECT card_id, round(ucl, 4) AS ucl, score, postcode, transaction_dt, epoch FROM lookup""",
    "incremental_late": f"""WITH {_TX}
SELECT {_COLS}, CAST(CASE WHEN ts < {_CUT} AND txn_id % 3 <> 0 THEN 0 ELSE 1 + txn_id % 2 END AS INTEGER) AS load FROM tx""",
    "incremental_lookup": f"""WITH {_LOOKUP.replace(f"FROM tx WHERE ts < {_CUT}", "FROM tx")}
SELECT card_id, round(ucl, 4) AS ucl, score, postcode, transaction_dt, epoch FROM lookup""",
    "customer_view": f"""WITH {_TX},
newest AS (
  SELECT * FROM tx QUALIFY row_number() OVER (PARTITION BY card_id ORDER BY epoch DESC, txn_id DESC) = 1)
SELECT CAST(c_custkey AS VARCHAR) AS card_id, CAST(c_custkey AS VARCHAR) AS member_id,
       CAST(c_nationkey AS VARCHAR) AS country, c_mktsegment AS city, c_acctbal AS score,
       amount, postcode, transaction_dt
FROM customer LEFT JOIN newest ON card_id = CAST(c_custkey AS VARCHAR)""",
    "customer_view_live": f"""WITH RECURSIVE {_FOLD},
judged AS (SELECT a.card_id, a.amount, a.postcode, a.transaction_dt, a.epoch, a.txn_id, f.status, f.speed_rule, f.amount_rule,
    f.score_rule FROM fold f JOIN arrivals a ON a.txn_id = f.txn_id),
last_genuine AS (SELECT * FROM judged WHERE status = 'GENUINE'
  QUALIFY row_number() OVER (PARTITION BY card_id ORDER BY epoch DESC, txn_id DESC) = 1),
newest AS (SELECT * FROM judged QUALIFY row_number() OVER (PARTITION BY card_id ORDER BY epoch DESC, txn_id DESC) = 1),
frauds AS (SELECT card_id, count(*) FILTER (WHERE status = 'FRAUD') AS frauds FROM judged GROUP BY card_id)
SELECT CAST(c_custkey AS VARCHAR) AS card_id, CAST(c_custkey AS VARCHAR) AS member_id,
  CAST(c_nationkey AS VARCHAR) AS country, c_mktsegment AS city, c_acctbal AS score,
  n.amount, n.postcode, n.transaction_dt, n.status, n.speed_rule, n.amount_rule, n.score_rule,
  coalesce(frauds, 0) AS frauds, round(l.ucl, 4) AS ucl,
  coalesce(g.postcode, l.postcode) AS genuine_postcode, coalesce(g.transaction_dt, l.transaction_dt) AS genuine_dt
FROM customer LEFT JOIN newest n ON n.card_id = CAST(c_custkey AS VARCHAR)
LEFT JOIN frauds q ON q.card_id = CAST(c_custkey AS VARCHAR) LEFT JOIN lookup l ON l.card_id = CAST(c_custkey AS VARCHAR)
LEFT JOIN last_genuine g ON g.card_id = CAST(c_custkey AS VARCHAR)""",
    "fraud_rules": f"""WITH {_JOURNEYS},
ruled AS (
  SELECT *, {_FAST} AS speed_rule, amount > ucl AS amount_rule, score < 200 AS score_rule FROM journeys)
SELECT {_COLS}, km, secs, speed_rule, amount_rule, score_rule,
       CASE WHEN NOT known THEN 'UNKNOWN_CARD' WHEN km IS NULL THEN 'UNKNOWN_POSTCODE'
            WHEN speed_rule OR amount_rule OR score_rule THEN 'FRAUD' ELSE 'GENUINE' END AS status
FROM ruled""",
    "fraud_score": _DECISIONS,
    "stream_fraud": f"SELECT sha256('transactions|0|' || txn_id) AS decision_id, d.* FROM ({_DECISIONS}) d",
    "stream_fraud_keyed": f"SELECT sha256('transactions|0|' || txn_id) AS decision_id, d.* FROM ({_DECISIONS}) d",
    "lookup_moved": f"""WITH RECURSIVE {_FOLD},
last_genuine AS (
  SELECT a.card_id, a.postcode, a.transaction_dt, a.epoch FROM fold f JOIN arrivals a ON a.txn_id = f.txn_id
  WHERE f.status = 'GENUINE'
  QUALIFY row_number() OVER (PARTITION BY a.card_id ORDER BY a.epoch DESC, a.txn_id DESC) = 1)
SELECT l.card_id, round(l.ucl, 4) AS ucl, l.score,
       CASE WHEN g.card_id IS NULL THEN l.postcode ELSE g.postcode END AS postcode,
       CASE WHEN g.card_id IS NULL THEN l.transaction_dt ELSE g.transaction_dt END AS transaction_dt,
       CASE WHEN g.card_id IS NULL THEN l.epoch ELSE g.epoch END AS epoch
FROM lookup l LEFT JOIN last_genuine g ON l.card_id = g.card_id""",
    "held_out_pairs": f"""WITH {_CLICKS},
parted AS (SELECT user_id, song_id, count(*) AS frequency,
    CAST('0x' || left(md5('42:' || user_id || ':' || song_id), 7) AS BIGINT) % 1000 < 800 AS train FROM clicks GROUP BY ALL)
SELECT user_id, song_id, frequency FROM parted WHERE NOT train
  AND user_id IN (SELECT user_id FROM parted WHERE train) AND song_id IN (SELECT song_id FROM parted WHERE train)""",
    "account_split": f"""WITH {_CLEAN}
SELECT account_id, CASE WHEN CAST('0x' || left(md5('42:' || account_id), 7) AS BIGINT) % 1000 < 700 THEN 'train'
  ELSE 'test' END AS split FROM clean""",
    "top_partners": """WITH v AS (
  SELECT vec_id AS id, list_transform(embedding, lambda c: floor(c::DOUBLE * 16)) AS x FROM embeddings WHERE embedding IS NOT NULL)
SELECT a.id AS user, b.id AS song, CAST(row_number() OVER (PARTITION BY a.id
         ORDER BY list_dot_product(a.x, b.x) DESC, b.id) AS INTEGER) AS rank, list_dot_product(a.x, b.x) AS score
FROM v a JOIN v b ON a.id % 4 = 1 AND b.id % 4 <> 1 QUALIFY rank <= 10""",
    "play_frequency": f"WITH {_CLICKS} SELECT user_id, song_id, count(*) AS frequency FROM clicks GROUP BY ALL",
    "label_index": f"""WITH {_CLICKS},
counts AS (SELECT user_id, count(DISTINCT song_id) AS n FROM clicks GROUP BY user_id)
SELECT user_id, n, CAST(row_number() OVER (ORDER BY n DESC, user_id) - 1 AS INTEGER) AS user_index FROM counts""",
    "cohort_clicks": f"WITH {_CLICKS} SELECT user_id, song_id, cluster FROM clicks JOIN cohorts USING (user_id)",
    "click_artist": f"""WITH {_CLICKS}
SELECT DISTINCT cluster, user_id, song_id, p_brand AS artist_id
FROM clicks JOIN cohorts USING (user_id) JOIN part ON song_id = CAST(p_partkey AS VARCHAR)""",
    "notification_clicks": f"""SELECT CAST({_K} AS VARCHAR) AS notification_id, strftime(ts, '%Y%m%d') AS date,
       count(*) AS clicks, count(DISTINCT user_id) AS users
FROM events WHERE event_type = 'click' GROUP BY 1, 2""",
    "cohort_ctr": f"WITH {_RATES} SELECT cluster, notification_id, clickers, cohort_size, ctr FROM rates",
    "cohort_best": f"""WITH {_RATES}
SELECT cluster, notification_id, clickers, cohort_size, ctr FROM rates
QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY ctr DESC, notification_id) = 1""",
    "first_accounts": f"WITH {_CLEAN} SELECT account_id, gender, text1 FROM clean ORDER BY account_id LIMIT 10",
    "account_counts": """SELECT count(*) AS n_read,
       count(*) FILTER (WHERE text IS NOT NULL AND lang IS NOT NULL) AS n_whole,
       count(*) FILTER (WHERE text IS NOT NULL AND lang NOT IN ('unknown', '')) AS n_known,
       count(*) FILTER (WHERE text <> '' AND lang NOT IN ('unknown', '')) AS n_kept FROM documents""",
    "text_clean": f"WITH {_CLEAN} SELECT account_id, gender, text1 FROM clean",
    "text_tokens": f"""WITH {_TOKENS}
SELECT account_id, CAST(len(words) AS BIGINT) AS n_tokens, coalesce(array_to_string(words, '|'), '') AS tokens
FROM tokens""",
    "text_terms": f"""WITH {_TERMS}
SELECT account_id, CAST(len(filtered) AS BIGINT) AS n_terms, coalesce(array_to_string(filtered, '|'), '') AS terms
FROM terms""",
    "term_idf": f"""WITH {_TERMS},
once AS (SELECT DISTINCT account_id, unnest(filtered) AS term FROM terms)
SELECT term, count(*) AS df, round(ln(((SELECT count(*) FROM terms) + 1)::DOUBLE / (count(*) + 1)), 6) AS idf
FROM once GROUP BY term""",
    "classification_metrics": f"WITH {_METRICS} "
    + " UNION ALL ".join(
        _metric(n, c)
        for n, c in [
            ("accuracy", "accuracy"),
            ("weightedPrecision", "weighted_precision"),
            ("weightedRecall", "weighted_recall"),
            ("f1", "f1"),
        ]
    ),
    "rfm": """SELECT o_custkey AS "CustomerID",
       CAST(min(date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-02')) AS INTEGER) AS "Recency",
       count(DISTINCT o_orderkey) AS "Frequency", CAST(round(sum(CAST(l_quantity AS DECIMAL(18, 4)) * CAST(l_extendedprice AS DECIMAL(18, 4))), 2) AS DOUBLE) AS "Monetary"
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_custkey""",
}
