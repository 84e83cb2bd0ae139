"""The same results as :mod:`sparkmon.plans.catalog`, as SQL for DuckDB over the same tables."""

from sparkmon import constants as K
from sparkmon.functions.sensors import signature_weights
from sparkmon.functions.text import TOKEN_PATTERN, WHITESPACE
from sparkmon.plans.catalog import CURSOR, REFERENCE_END, STREAM_PARTS, TOP_N, TRAIN_END
from sparkmon.sources.files import packaged_texts
from sparkmon.plans.telemetry import (
    FAULT_INDEX,
    LABEL,
    identity_sql,
    number,
    sensor_sql,
    surrogate_sql,
)


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def view_sql(clip: bool = True) -> str:
    columns = ",\n ".join([*identity_sql(), *[sensor_sql(s, clip) for s in K.SENSORS]])
    return f"""SELECT {columns}, label, CASE WHEN label = 1 THEN fk END AS fault_k
 FROM (SELECT *, {LABEL} AS label, {FAULT_INDEX} AS fk FROM events) e"""


def z(sensor: str) -> str:
    spec = K.SENSOR_SPECS[sensor]
    return f"(({sensor} - {number(spec['mean'])})/{number(spec['std'])})"


def rounded(columns: list[str]) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


def averages(prefix: str = "avg_") -> str:
    return ", ".join(f"round(avg({s}), 2) AS {prefix}{s}" for s in K.SENSORS)


def per_sensor(template: str, source: str) -> str:
    """UNION ALL of one SELECT per sensor; ``{s}``, ``{i}``, ``{lo}``, ``{hi}``, ``{z}`` are filled in."""
    return " UNION ALL ".join(
        "SELECT "
        + template.format(
            s=s, i=i, z=z(s), lo=number(K.SENSOR_SPECS[s]["lo"]), hi=number(K.SENSOR_SPECS[s]["hi"])
        )
        + f" FROM {source}"
        for i, s in enumerate(K.SENSORS)
    )


VIEW = f"WITH tel AS ({view_sql()})"
SCORED = f"{VIEW}, scored AS (SELECT *, {surrogate_sql()} AS anomaly_prob FROM tel)"
ALERTS = f"{SCORED}, alerts AS (SELECT * FROM scored WHERE anomaly_prob >= {K.ALERT_PROB_THRESHOLD})"
WINDOWS = """SELECT time_bucket(INTERVAL '{w}', event_time) AS window_start,
 time_bucket(INTERVAL '{w}', event_time) + INTERVAL '{w}' AS window_end, site, machine_type,
 count(*) AS events, {avgs} FROM tel GROUP BY ALL"""

ELEVATED = f"""elevated AS (
 SELECT event_id, sensor, z, ord, row_number() OVER (PARTITION BY event_id ORDER BY z DESC, ord) AS position
 FROM ({per_sensor("event_id, '{s}' AS sensor, {i} AS ord, round({z}, 2) AS z, {z} AS raw", "scored")})
 WHERE raw >= {K.ELEVATED_Z})"""


def fault_ctes(cosine: bool = False) -> str:
    signatures = ", ".join(
        f"({i}, '{fault}', '{s}', {place}, {number(weight if cosine else 1.0)})"
        for i, (fault, sig) in enumerate(K.FAULTS.items())
        for place, (s, weight) in enumerate(signature_weights(sig).items())
    )
    return f"""signatures(ord, fault, sensor, place, weight) AS (VALUES {signatures}),
 fault_scores AS (SELECT e.event_id, s.fault, s.ord,
  list_sum(list(e.z * s.weight ORDER BY s.place)) AS score
  FROM elevated e JOIN signatures s USING (sensor) GROUP BY ALL),
 faults AS (SELECT event_id, fault FROM fault_scores
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY score DESC, ord) = 1)"""


def symptom_ctes() -> str:
    keywords = ", ".join(f"('{s}', {i}, '{w}')" for i, (s, w) in enumerate(K.SENSOR_KEYWORDS.items()))
    return f"""keywords(sensor, ord, words) AS (VALUES {keywords}),
 symptoms AS (SELECT e.event_id,
  string_agg(replace(e.sensor,'_',' ') || ' +' || CAST(e.z AS VARCHAR) || 'σ', ', ' ORDER BY position)
   FILTER (WHERE position <= {K.TOP_SYMPTOMS}) AS symptom,
  string_agg(k.words, ' ' ORDER BY k.ord) AS words
  FROM elevated e JOIN keywords k USING (sensor) GROUP BY 1)"""


SEVERITY = (
    f"CASE WHEN anomaly_prob >= {K.CRITICAL_PROB} THEN 'critical' "
    f"WHEN anomaly_prob >= {K.WARNING_PROB} THEN 'warning' ELSE 'watch' END"
)
STOP = ", ".join(quote(w) for w in K.STOP_WORDS)


def action_sql(text: str) -> str:
    blank = " || ".join(f"chr({ord(c)})" for c in WHITESPACE)
    section = (
        f"list_filter(string_split({text}, '## '), lambda c: "
        f"starts_with(lower(c), '{K.ACTION_HEADING}') AND contains(c, chr(10)))[1]"
    )
    body = f"substring({section}, instr({section}, chr(10)) + 1)"
    return (
        f"coalesce(replace(trim({body}, {blank}), chr(10), ' '), "
        f"substring(trim({text}, {blank}), 1, {K.ACTION_FALLBACK_CHARS}))"
    )


def retrieval_ctes(docs: str, queries: str) -> str:
    """``pairs(qid, did, score)`` for ``docs(did, text)`` and ``queries(qid, text)``."""
    tokens = "unnest(regexp_extract_all(lower(text), '" + TOKEN_PATTERN + "'))"
    return f"""
 d AS (SELECT did, tok, count(*) AS tf FROM (SELECT did, {tokens} AS tok FROM {docs})
  WHERE tok NOT IN ({STOP}) GROUP BY ALL),
 idf AS (SELECT tok, count(*) AS df, ln((1 + (SELECT count(*) FROM {docs})) / (1.0 + count(*))) + 1 AS idf
  FROM d GROUP BY tok),
 dw AS (SELECT did, tok, tf*idf AS w FROM d JOIN idf USING (tok)),
 dn AS (SELECT did, sqrt(sum(w*w)) AS norm FROM dw GROUP BY did),
 q AS (SELECT qid, tok, count(*) AS tf FROM (SELECT qid, {tokens} AS tok FROM {queries})
  WHERE tok NOT IN ({STOP}) GROUP BY ALL),
 qw AS (SELECT qid, tok, tf*idf AS w FROM q JOIN idf USING (tok)),
 qn AS (SELECT qid, sqrt(sum(w*w)) AS norm FROM qw GROUP BY qid),
 pairs AS (SELECT qid, did, round(sum(qw.w*dw.w)/any_value(qn.norm)/any_value(dn.norm), 9) AS score
  FROM qw JOIN dw USING (tok) JOIN qn USING (qid) JOIN dn USING (did) GROUP BY qid, did),
 best AS (SELECT qid, did, score FROM pairs
  QUALIFY row_number() OVER (PARTITION BY qid ORDER BY score DESC, did) = 1)"""


def incident_ctes(source: str = "alerts") -> str:
    """``incidents`` for the alert rows of ``source``."""
    guides = ", ".join(f"({quote(n)}, {quote(t)})" for n, t in packaged_texts())
    forced = " ".join(f"WHEN '{f}' THEN '{g}'" for f, g in K.FAULT_GUIDES.items())
    return f"""{ELEVATED}, {fault_ctes()}, {symptom_ctes()},
 guides(did, text) AS (VALUES {guides}),
 described AS (SELECT a.*, coalesce(f.fault, '{K.NO_FAULT}') AS fault,
  coalesce(s.symptom, '{K.NO_SYMPTOM}') AS symptom,
  replace(a.machine_type, '_', ' ') || coalesce(' ' || s.words, '') AS query_text
  FROM {source} a LEFT JOIN faults f USING (event_id) LEFT JOIN symptoms s USING (event_id)),
 asked AS (SELECT DISTINCT query_text AS qid, query_text AS text FROM described),
 {retrieval_ctes("guides", "asked")},
 chosen AS (SELECT d.*, CASE fault {forced} END AS forced,
  coalesce(CASE fault {forced} END, b.did, (SELECT min(did) FROM guides)) AS did
  FROM described d LEFT JOIN best b ON b.qid = d.query_text),
 incidents AS (SELECT c.event_id, c.event_time, c.machine_id, c.site, c.machine_type,
  c.anomaly_prob AS alert_prob, round(c.anomaly_prob, 3) AS anomaly_prob, {SEVERITY} AS severity, symptom,
  replace(CASE WHEN forced IS NULL THEN c.did ELSE fault END, '_', ' ') AS likely_cause,
  {action_sql("g.text")} AS recommended_action, c.did || '.md' AS source,
  round(coalesce(p.score, 0), 3) AS retrieval_score
  FROM chosen c JOIN guides g USING (did) LEFT JOIN pairs p ON p.qid = c.query_text AND p.did = c.did)"""


INCIDENT_COLUMNS = """event_id, machine_id, site, machine_type, round(alert_prob, 6) AS alert_prob,
 anomaly_prob, severity, symptom, likely_cause, recommended_action, source, retrieval_score"""
INCIDENTS = f"{ALERTS}, {incident_ctes()}"

DAY = "date_diff('day', DATE '1970-01-01', CAST(event_time AS DATE))"
REFERENCE = f"""ref AS ({per_sensor(
    "'{s}' AS sensor, avg({s}) AS mean, stddev_samp({s}) AS std",
    f"(SELECT * FROM tel WHERE event_time < TIMESTAMP '{REFERENCE_END} 00:00:00')")})"""
DRIFT = f"""{REFERENCE},
 long AS ({per_sensor(
     DAY + " AS batch_id, '{s}' AS sensor, {s} AS v, {s} < {lo} OR {s} > {hi} AS bad,"
     f" anomaly_prob >= {K.ALERT_PROB_THRESHOLD} AS hit", "scored")}),
 detail AS (SELECT batch_id, count(*) AS n_events, CAST(sum(CAST(hit AS INT)) AS BIGINT) AS n_alerts, sensor,
  round(avg(v), 3) AS batch_mean, round(any_value(mean), 3) AS ref_mean,
  round(abs(avg(v) - any_value(mean)) / any_value(std), 3) AS drift_z,
  abs(avg(v) - any_value(mean)) / any_value(std) > {K.DRIFT_Z_THRESHOLD} AS drifted,
  CAST(sum(CAST(bad AS INT)) AS BIGINT) AS out_of_spec
  FROM long JOIN ref USING (sensor) GROUP BY batch_id, sensor),
 summary AS (SELECT batch_id, CAST(sum(CAST(drifted AS INT)) AS BIGINT) AS n_drifted_sensors,
  max(drift_z) AS max_drift_z, CAST(sum(out_of_spec) AS BIGINT) AS total_out_of_spec,
  max(n_events) AS n_events, max(n_alerts) AS n_alerts FROM detail GROUP BY batch_id)"""

HOURLY = f"wm AS ({WINDOWS.format(w='1 hour', avgs=averages())})"
POSITION = f"""starts AS (SELECT window_start, sum(events) AS events,
  row_number() OVER (ORDER BY window_start) AS rn FROM wm GROUP BY window_start),
 cur AS (SELECT max(window_start) FILTER (WHERE rn <= {CURSOR}) AS now, count(*) AS n_windows,
  least(count(*), {CURSOR}) AS cursor,
  CAST(sum(events) FILTER (WHERE rn <= {CURSOR}) AS BIGINT) AS events_seen FROM starts)"""
PREFIX = """prefix AS (SELECT * FROM summary QUALIFY row_number() OVER (ORDER BY batch_id) <=
  greatest(1, (SELECT round_even((SELECT count(*) FROM summary) * cursor / n_windows, 0) FROM cur)))"""
SEEN = "seen AS (SELECT * FROM alerts WHERE coalesce(event_time <= (SELECT now FROM cur), true))"


def count_by(column: str, source: str) -> str:
    return f"SELECT {column}, count(*) AS n FROM {source} GROUP BY 1 ORDER BY n DESC, {column}"


def counts_text(column: str) -> str:
    return f"""(SELECT string_agg({column} || '=' || n, ',' ORDER BY {column})
  FROM (SELECT {column}, count(*) AS n FROM incidents GROUP BY 1))"""


EVENT_COLUMNS = "event_id, event_time, site, machine_id, machine_type"
SENSOR_LIST = ", ".join(K.SENSORS)
FAULT_NAME = "CASE fault_k " + " ".join(f"WHEN {i} THEN '{f}'" for i, f in enumerate(K.FAULTS)) + " END"

FINISHED = (
    "WHERE window_end <= (SELECT date_trunc('milliseconds', max(event_time)) - INTERVAL '2 minutes' FROM tel)"
)
IS_FINISHED = FINISHED.removeprefix("WHERE ")
BOUNDS = f"(SELECT min({DAY}) AS low, max({DAY}) AS high FROM tel)"
PART = (
    f"CAST(({DAY} - (SELECT low FROM {BOUNDS})) // "
    f"((SELECT (high - low) // {STREAM_PARTS} + 1 FROM {BOUNDS})) AS BIGINT)"
)
SPLIT = f"""split AS (SELECT *, CAST('0x' || substring(md5('{K.SEED}:' || event_id), 1, 6) AS BIGINT) % 1000
  < {round(K.TRAIN_FRACTION * 1000)} AND event_time < TIMESTAMP '{TRAIN_END} 00:00:00' AS training FROM tel)"""


def feature_ctes() -> str:
    """Standardised sensors and category flags; levels go by frequency, then by name."""
    levels, flags = [], []
    for column, values in (("machine_type", K.MACHINE_TYPES), ("site", K.SITES)):
        levels.append(
            f"{column}_levels AS (SELECT {column}, row_number() OVER (ORDER BY count(*) DESC, {column}) AS level "
            f"FROM split WHERE training GROUP BY 1)"
        )
        flags += [
            f"CAST({column} = (SELECT {column} FROM {column}_levels WHERE level = {i + 1}) AS DOUBLE)"
            for i in range(len(values))
        ]
    raw = [*K.SENSORS, *flags]
    columns = ", ".join(f"{c} AS r{i}" for i, c in enumerate(raw))
    means = ", ".join(f"avg(r{i}) AS m{i}, stddev_samp(r{i}) AS s{i}" for i in range(len(raw)))
    scaled = ", ".join(
        f"round(CASE WHEN s{i} = 0 THEN 0 ELSE (r{i} - m{i}) / s{i} END, 6) AS f{i}" for i in range(len(raw))
    )
    return (
        f"{', '.join(levels)}, raw AS (SELECT event_id, training, {columns} FROM split), "
        f"scale AS (SELECT {means} FROM raw WHERE training) SELECT event_id, {scaled} FROM raw, scale"
    )


ORACLES: dict[str, str] = {
    "window_metrics_1m": f"{VIEW} {WINDOWS.format(w='1 minute', avgs=averages())}",
    "window_metrics_1h": f"{VIEW} {WINDOWS.format(w='1 hour', avgs=averages())}",
    "feature_reference": f"{VIEW}, {REFERENCE} SELECT sensor, {rounded(['mean', 'std'])} FROM ref",
    "drift_detail": f"{SCORED}, {DRIFT} SELECT * FROM detail",
    "drift_summary": f"{SCORED}, {DRIFT} SELECT * FROM summary",
    "out_of_spec": f"WITH tel AS ({view_sql(clip=False)}) "
    + per_sensor("'{s}' AS sensor, count(*) FILTER (WHERE {s} < {lo} OR {s} > {hi}) AS out_of_spec", "tel"),
    "elevated_sensors": f"{SCORED}, {ELEVATED} SELECT event_id, position, sensor, z FROM elevated",
    "fault_match": f"{SCORED}, {ELEVATED}, {fault_ctes()} SELECT event_id, "
    f"coalesce(fault, '{K.NO_FAULT}') AS fault FROM tel LEFT JOIN faults USING (event_id)",
    "fault_match_cosine": f"{SCORED}, {ELEVATED}, {fault_ctes(cosine=True)} SELECT event_id, "
    f"coalesce(fault, '{K.NO_FAULT}') AS fault FROM tel LEFT JOIN faults USING (event_id)",
    "symptom_severity": f"{SCORED}, {ELEVATED}, {symptom_ctes()} SELECT event_id, "
    f"coalesce(symptom, '{K.NO_SYMPTOM}') AS symptom, {SEVERITY} AS severity, "
    "replace(machine_type, '_', ' ') || coalesce(' ' || words, '') AS query_text "
    "FROM scored LEFT JOIN symptoms USING (event_id)",
    "alerts": f"{ALERTS} SELECT {EVENT_COLUMNS}, {SENSOR_LIST}, {rounded(['anomaly_prob'])} FROM alerts",
    "tfidf_terms": "WITH docs AS (SELECT doc_id AS did, text FROM documents), "
    "asked AS (SELECT item_id AS qid, text FROM benchmark),"
    f"{retrieval_ctes('docs', 'asked')} SELECT tok AS token, df, round(idf, 6) AS idf FROM idf",
    "tfidf_top1": "WITH docs AS (SELECT doc_id AS did, text FROM documents), "
    "asked AS (SELECT item_id AS qid, text FROM benchmark),"
    f"{retrieval_ctes('docs', 'asked')} SELECT item_id, coalesce(did, (SELECT min(did) FROM docs)) AS doc_id, "
    "round(coalesce(score, 0), 6) AS score FROM benchmark LEFT JOIN best ON qid = item_id",
    "tfidf_index_merge": "WITH docs AS (SELECT doc_id AS did, text FROM documents), "
    "asked AS (SELECT item_id AS qid, text FROM benchmark),"
    f"{retrieval_ctes('docs', 'asked')} SELECT tok AS token, any_value(df) AS df, round(any_value(idf), 6) AS idf, "
    "round(max(w / norm), 6) AS bound FROM dw JOIN dn USING (did) JOIN idf USING (tok) GROUP BY tok",
    "section_action": "WITH guides AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN text ELSE "
    "'# ' || source || chr(10) || chr(10) || '## Symptoms' || chr(10) || text || chr(10) || chr(10) || "
    "'## Recommended Action' || chr(10) || '  ' || text || chr(10) END AS text FROM documents) "
    f"SELECT doc_id, {action_sql('text')} AS recommended_action FROM guides",
    "incidents": f"{INCIDENTS} SELECT {INCIDENT_COLUMNS} FROM incidents",
    "incidents_topn": f"{ALERTS}, top AS (SELECT * FROM alerts ORDER BY anomaly_prob DESC, event_id "
    f"LIMIT {TOP_N}), {incident_ctes('top')} SELECT {INCIDENT_COLUMNS} FROM incidents",
    "incidents_by_cause": f"{INCIDENTS} {count_by('likely_cause', 'incidents')}",
    "incidents_by_severity": f"{INCIDENTS} {count_by('severity', 'incidents')}",
    "throughput_by_site": f"{VIEW}, {HOURLY} SELECT site, window_start, CAST(sum(events) AS BIGINT) AS events "
    "FROM wm GROUP BY ALL",
    "alerts_by_type": f"{ALERTS} {count_by('machine_type', 'alerts')}",
    "kpi_at_cursor": f"{ALERTS}, {HOURLY}, {POSITION}, {DRIFT}, {PREFIX}, {SEEN} "
    "SELECT now, n_windows, events_seen, (SELECT count(*) FROM seen) AS n_alerts, "
    "(SELECT arg_max(n_drifted_sensors, batch_id) FROM prefix) AS drifted_sensors, "
    "round((SELECT count(*) FROM seen) / events_seen * 100, 2) AS alert_rate_pct FROM cur",
    "top_incidents": f"{INCIDENTS}, {HOURLY}, {POSITION}, {SEEN} SELECT {INCIDENT_COLUMNS}, "
    f"substring(recommended_action, 1, {K.PREVIEW_CHARS}) AS action_preview FROM incidents i "
    "WHERE machine_id IN (SELECT machine_id FROM seen) "
    f"ORDER BY i.alert_prob DESC, event_id LIMIT {K.TOP_INCIDENTS}",
    "drift_prefix": f"{SCORED}, {HOURLY}, {POSITION}, {DRIFT}, {PREFIX} SELECT * FROM prefix",
    "run_summary": f"{INCIDENTS}, {DRIFT} SELECT count(*) AS n_events, (SELECT count(*) FROM alerts) AS n_alerts, "
    "round((SELECT count(*) FROM alerts) / count(*) * 100, 2) AS alert_rate_pct, "
    "round(avg(label) * 100, 2) AS true_anomaly_rate_pct, (SELECT count(*) FROM incidents) AS n_incidents, "
    f"{counts_text('likely_cause')} AS incidents_by_cause, {counts_text('severity')} AS incidents_by_severity, "
    "(SELECT string_agg(site, ',' ORDER BY site) FROM (SELECT DISTINCT site FROM tel)) AS sites, "
    "count(DISTINCT machine_id) AS machines, (SELECT count(*) FROM summary) AS drift_batches, "
    "(SELECT round(max(max_drift_z), 2) FROM (SELECT max_drift_z FROM summary ORDER BY batch_id DESC "
    f"LIMIT {K.TAIL_BATCHES})) AS max_drift_z_end, "
    "(SELECT arg_max(n_drifted_sensors, batch_id) FROM summary) AS drifted_at_end FROM tel",
    "confusion": f"""{SCORED}, c AS (SELECT count(*) FILTER (WHERE label = 1 AND hit) AS tp,
 count(*) FILTER (WHERE label = 0 AND hit) AS fp, count(*) FILTER (WHERE label = 1 AND NOT hit) AS fn,
 count(*) FILTER (WHERE label = 0 AND NOT hit) AS tn
 FROM (SELECT label, anomaly_prob >= {K.ALERT_PROB_THRESHOLD} AS hit FROM scored))
 SELECT tp, fp, fn, tn, round(CASE WHEN tp+fp = 0 THEN 0 ELSE tp/(tp+fp) END, 6) AS precision,
 round(CASE WHEN tp+fn = 0 THEN 0 ELSE tp/(tp+fn) END, 6) AS recall,
 round(CASE WHEN tp = 0 THEN 0 ELSE 2*tp/(2*tp+fp+fn) END, 6) AS f1,
 round((tp+tn)/(tp+fp+fn+tn), 6) AS accuracy FROM c""",
    "auc_exact": f"""{SCORED}, g AS (SELECT round(anomaly_prob, 9) AS p,
 count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg FROM scored GROUP BY 1),
 r AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
 AS below FROM g)
 SELECT round(CAST(sum(pos * (below + neg / 2)) AS DOUBLE) / sum(pos) / sum(neg), 6) AS auc FROM r""",
    "json_roundtrip": f"{VIEW} SELECT {EVENT_COLUMNS}, {SENSOR_LIST}, label, {FAULT_NAME} AS fault_type FROM tel",
    "quarantine": """SELECT reason, count(*) AS n FROM (SELECT CASE WHEN event_id % 97 = 0 THEN 'unreadable'
 WHEN event_id % 89 = 0 THEN 'event time' WHEN event_id % 83 = 0 THEN 'sensor value' END AS reason FROM events)
 WHERE reason IS NOT NULL GROUP BY 1 ORDER BY n DESC, reason""",
    "event_files": f"{VIEW} SELECT machine_type, count(*) AS n, true AS within_limit, true AS in_order FROM tel "
    "GROUP BY 1 ORDER BY n DESC, machine_type",
    "stream_window_metrics": f"{VIEW} SELECT * FROM ({WINDOWS.format(w='1 minute', avgs=averages())}) {FINISHED}",
    "stream_window_metrics_closed": f"{VIEW} SELECT *, {IS_FINISHED} AS closed "
    f"FROM ({WINDOWS.format(w='1 minute', avgs=averages())})",
    "stream_late": f"{VIEW} SELECT CAST(sum(events) AS BIGINT) AS events, CAST(1 AS BIGINT) AS late_rows "
    f"FROM ({WINDOWS.format(w='1 minute', avgs=averages())}) {FINISHED}",
    "stream_alerts": f"{ALERTS} SELECT {EVENT_COLUMNS}, {SENSOR_LIST}, {rounded(['anomaly_prob'])}, "
    f"{PART} AS batch_id FROM alerts",
    "stream_drift": f"{SCORED}, {DRIFT.replace(DAY + ' AS batch_id', PART + ' AS batch_id')} SELECT * FROM summary",
    "throughput_at_cursor": f"{VIEW}, wm AS ({WINDOWS.format(w='1 minute', avgs=averages())}), {POSITION} "
    "SELECT site, window_start, CAST(sum(events) AS BIGINT) AS events FROM wm "
    "WHERE coalesce(window_start <= (SELECT now FROM cur), true) GROUP BY ALL",
    "alerts_by_type_at_cursor": f"{ALERTS}, {HOURLY}, {POSITION}, {SEEN} {count_by('machine_type', 'seen')}",
    "feature_vectors": f"{VIEW}, {SPLIT}, {feature_ctes()}",
    "gbt_quality": f"{VIEW}, {SPLIT} SELECT count(*) AS n_scored, CAST(sum(label) AS BIGINT) AS positives, "
    "true AS accurate, true AS ranks_well FROM split WHERE NOT training",
    "gbt_scores": f"{VIEW}, {SPLIT} SELECT event_id, label, true AS in_range FROM split WHERE NOT training",
    "gbt_cv_metrics": f"{VIEW}, {SPLIT} SELECT "
    f"'{K.MODEL_NAME}' AS model, {K.CV_FOLDS} AS cv_folds, count(*) AS n_train, true AS depth_in_grid, true AS ranks_well "
    "FROM split WHERE training",
    "model_reload": "SELECT count(*) AS n, CAST(0 AS BIGINT) AS differing FROM events",
}
ORACLES["fault_match_table"] = f"""{SCORED}, {ELEVATED},
 taught AS (SELECT site, machine_type, CAST(event_time AS DATE) AS day, e.sensor, e.ord,
  round(avg(e.z), 4) AS weight FROM tel JOIN elevated e USING (event_id) WHERE label = 1 GROUP BY ALL),
 signatures AS (SELECT *, machine_type || ' ' || site || ' ' || CAST(day AS VARCHAR) AS fault,
  date_diff('day', DATE '1970-01-01', day) * 100000 + ascii(machine_type) * 200 + ascii(site) AS ordinal FROM taught),
 sums AS (SELECT t.event_id, s.fault, s.ordinal, round(list_sum(list(e.z * s.weight ORDER BY e.ord)), 6) AS score
  FROM tel t JOIN elevated e USING (event_id) JOIN signatures s ON s.sensor = e.sensor
  AND t.event_time >= s.day AND t.event_time < s.day + INTERVAL 7 DAYS GROUP BY ALL),
 best AS (SELECT event_id, fault FROM sums WHERE score > 0
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY score DESC, ordinal) = 1)
 SELECT event_id, coalesce(fault, '{K.NO_FAULT}') AS fault FROM tel LEFT JOIN best USING (event_id)"""
ORACLES["stream_model_scores"] = (
    f"{VIEW} SELECT {PART} AS batch_id, CASE WHEN {PART} = 0 THEN 1 ELSE 2 END AS model_version, count(*) AS n, "
    "CAST(0 AS BIGINT) AS differing FROM tel GROUP BY ALL"
)
ORACLES["stream_alerts_replayed"] = ORACLES["stream_alerts"]
ORACLES["logged_alerts_at_cursor"] = ORACLES["alerts_by_type_at_cursor"]
ORACLES["stream_late_rows"] = (
    f"{VIEW} SELECT 'late' AS event_id, * EXCLUDE (event_id) FROM (SELECT {EVENT_COLUMNS}, {SENSOR_LIST}, "
    f"(SELECT max({PART}) FROM tel) AS batch_id FROM tel ORDER BY event_time, tel.event_id LIMIT 1)"
)
ORACLES["end_to_end_summary"] = (
    f"SELECT * EXCLUDE (drift_batches, max_drift_z_end, drifted_at_end) FROM ({ORACLES['run_summary']})"
)
