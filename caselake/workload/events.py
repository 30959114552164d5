"""Live-event operators over the events table."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from caselake.functions import identity
from caselake.operators.projection import bind
from caselake.session import materialise, shared_folder, spread
from caselake.streaming import commits, contract, counters, pipeline, serve
from caselake.workload.inputs import read
from caselake.workload.registry import query
from caselake.workload.shaping import NINE, PEOPLE_SQL, TEST_KEYS, sql_hmac

# Event type to risk level.
RISK_OF_TYPE = {"view": "BLUE", "click": "GREEN", "signup": "YELLOW", "purchase": "ORANGE", "error": "RED"}
RISK_SQL = "CASE event_type " + " ".join(f"WHEN '{t}' THEN '{r}'" for t, r in RISK_OF_TYPE.items()) + " END"
AGE_SQL = "CAST(user_id % 96 AS INT)"
UNIT_SQL = "'UNIT-' || CAST(user_id % 40 AS STRING)"
# Faults, one kind per residue; the rest of the events are sound.
FAULT_SQL = "CAST(event_id % 97 AS INT)"


def triage_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Events with person, age, unit and place of their user."""
    events, customers = spread(read(spark, folder, "events")), read(spark, folder, "customer")
    nations = read(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("state"))
    people = bind(customers, {"number": identity.with_check_digits(F.expr(NINE))}).join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return events.join(people, F.col("user_id") == F.col("c_custkey")).select(
        F.col("event_id").cast("string").alias("event_id"), "ts", "user_id", "number", "state",
        F.expr(RISK_SQL).alias("risk_level"), F.expr(AGE_SQL).alias("age"), F.expr(UNIT_SQL).alias("unit_id"),
        (1100000 + F.col("c_nationkey")).cast("string").alias("municipality_code"), F.expr(FAULT_SQL).alias("fault"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("at"),
    )


TRIAGE_SQL = f"""{PEOPLE_SQL},
triage AS (SELECT CAST(event_id AS VARCHAR) AS event_id, ts, user_id, number, n_name AS state,
  {RISK_SQL} AS risk_level, {AGE_SQL} AS age, {UNIT_SQL} AS unit_id,
  CAST(1100000 + c.c_nationkey AS VARCHAR) AS municipality_code, {FAULT_SQL} AS fault,
  strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS moment
  FROM events JOIN customer c ON user_id = c.c_custkey JOIN nation ON c.c_nationkey = n_nationkey
  JOIN n2 ON n2.c_custkey = c.c_custkey)"""

# Fault number to the reasons it must give.
FAULTS = {
    1: "WRONG_EVENT_TYPE", 2: "MISSING_TRIAGE_ID", 3: "INVALID_AGE", 4: "INVALID_AGE", 5: "INVALID_AGE",
    6: "INVALID_SEX", 7: "INVALID_RISK_LEVEL", 8: "NOT_A_JSON_OBJECT", 9: "INVALID_NOTIFICATION_TIME",
    10: "INVALID_PERSON_ID", 11: "MISSING_UNIT_NAME,MISSING_STATE", 12: "WRONG_DISEASE_CODE",
}


def messages(rows: DataFrame) -> DataFrame:
    """Events as JSON text, with their faults."""
    fault, text = F.col("fault"), F.lit

    def unless(number, value, instead=None):
        return F.when(fault == number, F.lit(instead)).otherwise(value)

    patient = F.struct(
        unless(10, F.col("number"), "90000000000").alias("cpf"), text("A B").alias("full_name"),
        F.when(fault == 3, -1).when(fault == 4, 121).otherwise(F.col("age")).alias("age"),
        unless(6, text("F"), "X").alias("sex"), text("1").alias("phone"), text("a@example.invalid").alias("email"),
    )
    triage = F.struct(
        unless(9, F.col("at"), "soon").alias("notification_at"), unless(12, text("A90"), "B01").alias("disease_code"),
        text("SUSPECTED").alias("case_classification"), unless(7, F.col("risk_level"), "PINK").alias("risk_level"),
        text("2024-01-01").alias("symptoms_start_date"),
    )
    unit = F.struct(
        "unit_id", unless(11, text("Unit")).alias("unit_name"), "municipality_code",
        text("Town").alias("municipality_name"), unless(11, F.col("state")).alias("state"),
    )
    body = F.to_json(F.struct(
        "event_id", unless(1, text("TRIAGE_REGISTERED"), "OTHER").alias("event_type"),
        text("1.0").alias("schema_version"), F.col("at").alias("event_time"),
        text("hospital_simulator").alias("source_system"), unless(2, text("T-1"), "  ").alias("triage_id"),
        patient.alias("patient"), triage.alias("triage"), unit.alias("health_unit"),
    ))
    quoted_age = F.regexp_replace(body, r'"age":(\d+)', '"age":"$1"')
    return rows.select(
        "event_id",
        F.when(fault == 5, quoted_age).when(fault == 8, F.substring(body, 1, 40)).otherwise(body).alias("body"),
        F.col("ts").cast("timestamp").alias("arrived_at"),
    )


_REASONS_SQL = "CASE fault " + " ".join(f"WHEN {n} THEN '{r}'" for n, r in FAULTS.items()) + " ELSE '' END"


@query("q_event_contract", f"""
WITH {TRIAGE_SQL}
SELECT {_REASONS_SQL} AS reasons, count(*) AS n_events FROM triage GROUP BY 1""")
def event_contract(spark, folder):
    """STR2, STR3."""
    checked = contract.check(contract.parse(messages(triage_rows(spark, folder))))
    return checked.groupBy(F.concat_ws(",", "reasons").alias("reasons")).agg(F.count(F.lit(1)).alias("n_events"))


def sound_events(spark: SparkSession, folder: str) -> DataFrame:
    """All events as the counters take them, without the trip through JSON."""
    return triage_rows(spark, folder).withColumn("notification_instant", F.col("ts").cast("timestamp"))


_BAND_SQL = "CASE WHEN age >= 80 THEN '80+' ELSE CAST(age // 10 AS VARCHAR) || '0-' || CAST(age // 10 AS VARCHAR) || '9' END"
_RISK_SUMS = ", ".join(
    f"CAST(count_if(risk_level = '{r}') AS BIGINT) AS risk_{r.lower()}" for r in contract.RISK_LEVELS
)
FAN_SQL = f"""{TRIAGE_SQL},
fan AS (
  SELECT event_id, ts, risk_level, fault, unnest([
    {{'t': 'GLOBAL', 'v': NULL}}, {{'t': 'STATE', 'v': upper(state)}},
    {{'t': 'MUNICIPALITY', 'v': municipality_code}}, {{'t': 'UNIT', 'v': upper(unit_id)}},
    {{'t': 'AGE_GROUP', 'v': {_BAND_SQL}}}]) AS s,
    CAST(CAST('0x' || substring(sha256(event_id), 1, 8) AS BIGINT) % 8 AS INTEGER) AS shard
  FROM triage),
counters AS (
  SELECT s.t AS scope_type, s.v AS scope_value, shard, date_trunc('minute', ts) AS minute, count(*) AS total_triages,
    {_RISK_SUMS} FROM fan WHERE @WHERE@ GROUP BY ALL)"""


def fan_sql(where: str) -> str:
    return FAN_SQL.replace("@WHERE@", where)


_KEY_SQL = """scope_type || CASE WHEN scope_value IS NULL THEN '' ELSE '#' || scope_value END
  || '#SHARD#' || lpad(CAST(shard AS VARCHAR), 2, '0') AS scope_key"""
_COUNTER_SQL = f"""
SELECT {_KEY_SQL}, strftime(minute, '%Y-%m-%d %H:%M') AS minute, {', '.join(counters.COUNTERS)} FROM counters"""


def shown(df: DataFrame) -> DataFrame:
    """Counters with text keys."""
    return df.select(
        counters.scope_key(F.col("scope_type"), F.col("scope_value"), F.col("shard")).alias("scope_key"),
        F.date_format("minute", "yyyy-MM-dd HH:mm").alias("minute"), *counters.COUNTERS,
    )


@query("q_minute_counters", f"WITH {fan_sql('true')} {_COUNTER_SQL}")
def minute_counters(spark, folder):
    """STR6, STR7, AGG15, PRJ14."""
    return shown(counters.count_scopes(sound_events(spark, folder)))


FIRST, LAST = serve.window_of("2024-01-10T00:00:30Z", "2024-01-12T23:59:00+00:00")
_IN_WINDOW = f"minute BETWEEN TIMESTAMP '{FIRST:%Y-%m-%d %H:%M:%S}' AND TIMESTAMP '{LAST:%Y-%m-%d %H:%M:%S}'"
_SUMS = ", ".join(f"CAST(coalesce(sum({c}), 0) AS BIGINT) AS {c}" for c in counters.COUNTERS)
_ALL = fan_sql("true")


@query("q_indicators_series", f"""
WITH {_ALL} SELECT strftime(minute, '%Y-%m-%d %H:%M') AS minute, {_SUMS} FROM counters
WHERE scope_type = 'STATE' AND scope_value = 'NATION_7' AND {_IN_WINDOW} GROUP BY 1""")
def indicators_series(spark, folder):
    """QRY1 to QRY3, AGG16."""
    kind, value = serve.scope_of("state", "nation_7")
    series = serve.indicator_series(counters.count_scopes(sound_events(spark, folder)), kind, value, FIRST, LAST)
    return series.withColumn("minute", F.date_format("minute", "yyyy-MM-dd HH:mm"))


@query("q_indicators_total", f"""
WITH {_ALL} SELECT {_SUMS} FROM counters WHERE scope_type = 'GLOBAL' AND {_IN_WINDOW}""")
def indicators_total(spark, folder):
    """QRY3, AGG16."""
    kind, value = serve.scope_of()
    return serve.indicator_totals(counters.count_scopes(sound_events(spark, folder)), kind, value, FIRST, LAST)


_RANK_SQL = f"""{_ALL},
t AS (SELECT upper(n_name) AS state, {_SUMS} FROM nation LEFT JOIN counters
      ON scope_type = 'STATE' AND scope_value = upper(n_name) AND {_IN_WINDOW} GROUP BY 1),
ranked AS (SELECT *, row_number() OVER (ORDER BY total_triages DESC, state) AS position FROM t)"""


def ranking(spark: SparkSession, folder: str) -> DataFrame:
    states = read(spark, folder, "nation").select(F.upper("n_name").alias("state"))
    return serve.state_ranking(counters.count_scopes(sound_events(spark, folder)), FIRST, LAST, states)


@query("q_state_ranking", f"WITH {_RANK_SQL} SELECT * FROM ranked")
def state_ranking(spark, folder):
    """QRY5, WIN3."""
    return ranking(spark, folder)


@query("q_top_states", f"""
WITH {_RANK_SQL} SELECT state, position, total_triages FROM ranked WHERE total_triages > 0 ORDER BY position LIMIT 10""")
def top_states(spark, folder):
    """WIN3: the ten most active."""
    return serve.top_states(ranking(spark, folder)).select("state", "position", "total_triages")


@query("q_kpis", f"""
WITH {_RANK_SQL} SELECT CAST(sum(total_triages) AS BIGINT) AS total_triages,
  CAST(count_if(total_triages > 0) AS BIGINT) AS active_states,
  CAST(sum(risk_orange + risk_red) AS BIGINT) AS critical_triages FROM ranked""")
def kpis(spark, folder):
    """AGG17."""
    return serve.kpis(ranking(spark, folder))


def history_rows(spark: SparkSession, folder: str, ring: DataFrame) -> DataFrame:
    """History of all events, as the pipeline keeps it."""
    now = F.lit(datetime(2024, 2, 1, tzinfo=timezone.utc))
    checked = contract.check(contract.parse(messages(triage_rows(spark, folder))))
    return pipeline.pseudonymised(contract.split(checked)[0], ring, "v1").withColumns({
        "created_at": now, "expires_at": now + F.expr("INTERVAL 90 DAYS"),
    })


@query("q_history_page", f"""
WITH {TRIAGE_SQL},
asked AS (SELECT c_custkey, CASE WHEN c_custkey % 10 = 9 THEN '90000000000' ELSE number END AS person_id FROM n2),
valid AS (SELECT * FROM triage WHERE fault NOT BETWEEN 1 AND 12),
h AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY moment DESC, event_id DESC) AS page_position FROM valid),
known AS (SELECT DISTINCT user_id FROM valid)
SELECT a.c_custkey, k.user_id IS NOT NULL AS found, h.event_id, h.moment AS notification_at, h.risk_level,
  CAST(h.page_position AS INTEGER) AS page_position
FROM asked a LEFT JOIN known k ON k.user_id = a.c_custkey AND a.person_id <> '90000000000'
LEFT JOIN h ON h.user_id = k.user_id AND h.page_position <= 5""")
def history_page(spark, folder):
    """QRY4, JON8, SRT3, KEY6, KEY7, KEY9: the first page of every person at once."""
    ring = identity.keyring(spark, TEST_KEYS)
    history = history_rows(spark, folder, ring)
    vault = pipeline.new_tokens(history, None)
    people = bind(read(spark, folder, "customer"), {"number": identity.with_check_digits(F.expr(NINE))}).select(
        "c_custkey", F.when(F.col("c_custkey") % 10 == 9, "90000000000").otherwise(F.col("number")).alias("person_id"),
    )
    page = serve.history_pages(history, vault, people, ring, "v1", limit=5, keep=("c_custkey",))
    return page.select("c_custkey", "found", "event_id", "notification_at", "risk_level", "page_position")


@query("q_token_vault", f"""
WITH {TRIAGE_SQL},
f AS (SELECT DISTINCT {sql_hmac('number', TEST_KEYS['v1'])} AS fingerprint FROM triage WHERE fault NOT BETWEEN 1 AND 12)
SELECT fingerprint, 'v1' AS key_version, 'pt_' || substring(sha256('token:' || fingerprint), 1, 32) AS patient_token FROM f""")
def token_vault(spark, folder):
    """KEY8, KEY9."""
    return pipeline.new_tokens(history_rows(spark, folder, identity.keyring(spark, TEST_KEYS)), None)


EXPIRY_AS_OF = datetime(2024, 4, 15, tzinfo=timezone.utc)


@query("q_expiry", """
WITH e AS (SELECT event_id, ts + INTERVAL 90 DAY AS history_until, ts + INTERVAL 30 DAY AS counter_until FROM events)
SELECT 'history' AS kind, count(*) AS live_rows, CAST(sum(event_id) AS BIGINT) AS id_sum FROM e
WHERE history_until > TIMESTAMP '2024-04-15' UNION ALL
SELECT 'counters', count(*), CAST(coalesce(sum(event_id), 0) AS BIGINT) FROM e WHERE counter_until > TIMESTAMP '2024-04-15'""")
def expiry(spark, folder):
    """STR9: rows still live at a fixed instant, by the retention of their table."""
    events = read(spark, folder, "events").withColumn("processed", F.col("ts").cast("timestamp"))

    def kept(kind):
        days = pipeline.RETENTION_DAYS[kind]
        stamped = events.withColumn("expires_at", F.col("processed") + F.expr(f"INTERVAL {days} DAYS"))
        return pipeline.live(stamped, EXPIRY_AS_OF).agg(
            F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("live_rows"),
            F.coalesce(F.sum("event_id"), F.lit(0)).alias("id_sum"),
        )

    return kept("history").unionByName(kept("counters"))


def timed_feed(spark: SparkSession, label: str) -> tuple[pipeline.Feed, str]:
    home = shared_folder(spark, label)
    return pipeline.Feed("main", f"{home}/tables", TEST_KEYS, "v1"), home


def run_timed(spark: SparkSession, feed: pipeline.Feed, home: str, sent: DataFrame) -> None:
    """Drop messages with the time they are processed at into the inbox, and run the feed over what is new there.

    Each file line is the time in microseconds, a blank and the message.
    """
    sent.select(F.concat_ws(" ", F.unix_micros("arrived_at"), "body")).write.mode("append").text(f"{home}/inbox")
    lines = pipeline.read_files(spark, f"{home}/inbox").select(F.split("body", " ", 2).alias("part"))
    stream = lines.select(
        F.col("part")[1].alias("body"), F.timestamp_micros(F.col("part")[0].cast("long")).alias("arrived_at"))
    pipeline.start(stream, feed, f"{home}/checkpoint", True, F.col("arrived_at")).awaitTermination()


REPLAYED = datetime(2024, 3, 1, tzinfo=timezone.utc)


@query("q_stream_replay", f"""
WITH {TRIAGE_SQL}, sound AS (SELECT * FROM triage WHERE fault NOT BETWEEN 1 AND 12)
SELECT event_id, moment AS notification_at, '2024-03-01' AS counted_on FROM sound UNION ALL
SELECT event_id, strftime(ts + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%SZ'), '2024-03-09' FROM sound WHERE CAST(event_id AS BIGINT) % 7 = 0""")
def stream_replay(spark, folder):
    """STR4, STR10: on day 5 and 8 events come back, as they were or an hour later.

    The id refuses both on day 5. On day 8 the id is forgotten: what the history holds still counts once, what is new counts.
    """
    feed, home = timed_feed(spark, "replay")
    rows = triage_rows(spark, folder)
    later = rows.withColumn("at", F.date_format(F.col("ts") + F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    number = F.col("event_id").cast("long")
    for day, sent in (
        (0, rows),
        (5, rows.where(number % 5 == 0).unionByName(later.where(number % 11 == 0))),
        (8, rows.where(number % 3 == 0).unionByName(later.where(number % 7 == 0))),
    ):
        stamp = F.lit(REPLAYED).cast("timestamp") + F.make_dt_interval(F.lit(day))
        run_timed(spark, feed, home, messages(sent).withColumn("arrived_at", stamp))
    history = pipeline.table(spark, feed, "history")
    return history.select("event_id", "notification_at", F.date_format("created_at", "yyyy-MM-dd").alias("counted_on"))


_ENDS = "CAST(ts AS DATE) + {days} >= DATE '2024-04-15'"
_HISTORY_LEFT, _COUNTERS_LEFT, _VAULT_LEFT = (_ENDS.format(days=pipeline.RETENTION_DAYS[k]) for k in ("history", "counters", "vault"))


@query("q_stream_purge", f"""
WITH {TRIAGE_SQL}, sound AS (SELECT *, CAST(event_id AS BIGINT) AS n FROM triage WHERE fault NOT BETWEEN 1 AND 12)
SELECT 'history' AS kind, CAST(count(*) AS BIGINT) AS before_purge, CAST(count_if({_HISTORY_LEFT}) AS BIGINT) AS after_purge,
  CAST(coalesce(sum(n) FILTER (WHERE {_HISTORY_LEFT}), 0) AS BIGINT) AS id_sum FROM sound UNION ALL
SELECT 'counters', count(*), CAST(count_if({_COUNTERS_LEFT}) AS BIGINT), 0 FROM sound UNION ALL
SELECT 'vault', count(DISTINCT user_id), count(DISTINCT user_id) FILTER (WHERE {_VAULT_LEFT}), 0 FROM sound""")
def stream_purge(spark, folder):
    """STR9, KEY8: tables of a stream before, and after compaction and the removal of all days that have ended."""
    feed, home = timed_feed(spark, "purge")
    sent = messages(triage_rows(spark, folder))
    for half in (0, 1):
        run_timed(spark, feed, home, sent.where(F.col("event_id").cast("long") % 2 == half))

    def count(kind):
        rows = pipeline.table(spark, feed, kind)
        ids = F.sum(F.col("event_id").cast("long")) if kind == "history" else F.lit(None).cast("long")
        size = F.sum(F.when(F.col("scope_type") == "GLOBAL", F.col("total_triages"))) if kind == "counters" else F.count(F.lit(1))
        return rows.agg(F.coalesce(size, F.lit(0)).alias("n"), F.coalesce(ids, F.lit(0)).alias("id_sum")).withColumn("kind", F.lit(kind))

    kinds = ("history", "counters", "vault")
    before = materialise(reduce(DataFrame.unionByName, map(count, kinds)), "purge")
    pipeline.compact(spark, feed)
    commits.vacuum(spark, feed.root, pipeline.SCHEMAS, feed.name)
    pipeline.purge(spark, feed, EXPIRY_AS_OF)
    after = reduce(DataFrame.unionByName, map(count, kinds))
    return before.select("kind", F.col("n").alias("before_purge")).join(after.select("kind", F.col("n").alias("after_purge"), "id_sum"), "kind")


def run_stream(spark: SparkSession, folder: str, label: str) -> pipeline.Feed:
    """Write the messages as files, some of them twice and out of order, and run the feed."""
    home = shared_folder(spark, label)
    sent = messages(triage_rows(spark, folder))
    twice = sent.unionByName(sent.filter(F.col("event_id").cast("long") % 5 == 0))
    twice.repartition(4, F.xxhash64("body", F.rand(7))).select("body").write.text(f"{home}/inbox")
    feed = pipeline.Feed("main", f"{home}/tables", TEST_KEYS, "v1", exact=False)
    stream = pipeline.read_files(spark, f"{home}/inbox", max_files=2)
    pipeline.start(stream, feed, f"{home}/checkpoint", available_now=True).awaitTermination()
    return feed


@query("q_stream_counters", f"WITH {fan_sql('fault NOT BETWEEN 1 AND 12')} {_COUNTER_SQL}")
def stream_counters(spark, folder):
    """STR1 to STR8, STR10, STR11: counters after two micro-batches with repeated events."""
    feed = run_stream(spark, folder, "counters")
    return shown(counters.merge_deltas(pipeline.table(spark, feed, "counters")))


@query("q_stream_history", f"""
WITH {TRIAGE_SQL}
SELECT event_id, risk_level, state, age, {_BAND_SQL} AS age_group, moment AS notification_at,
  'pt_' || substring(sha256('token:' || {sql_hmac('number', TEST_KEYS['v1'])}), 1, 32) AS patient_token
FROM triage WHERE fault NOT BETWEEN 1 AND 12""")
def stream_history(spark, folder):
    """STR4, STR5, STR10, KEY7 to KEY9: each event once, nothing personal."""
    history = pipeline.table(spark, run_stream(spark, folder, "history"), "history")
    return history.select(
        "event_id", "risk_level", "state", "age", "age_group", "notification_at", "patient_token"
    )
