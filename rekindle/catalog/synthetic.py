"""Synthetic tables grown from the keys of the given ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rekindle.catalog.registry import query
from rekindle.functions import draws
from rekindle.plans import generate as g
from rekindle.sources import views
from rekindle.sources.tables import materialised
from rekindle.sources.views import SNAPSHOT

TODAY = SNAPSHOT
SEED = 42
_TODAY = f"DATE '{TODAY}'"


def _murmur(h: int, v: int) -> int:
    """Murmur3 of one 64-bit value in Python, for the constant salt."""

    def rotl(x: int, r: int) -> int:
        return ((x << r) | (x >> (32 - r))) & 0xFFFFFFFF

    for k in (v & 0xFFFFFFFF, v >> 32):
        k = rotl(k * 0xCC9E2D51 & 0xFFFFFFFF, 15) * 0x1B873593 & 0xFFFFFFFF
        h = (rotl(h ^ k, 13) * 5 + 0xE6546B64) & 0xFFFFFFFF
    h ^= 8
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    return h ^ h >> 16


def _uniforms(source: str, keys: Sequence[str], names: Sequence[str]) -> str:
    """SELECT adding one uniform column per name to ``source``.

    Spells out Murmur3 in unsigned 64-bit arithmetic, one nested SELECT per step so that
    no expression grows. A 32-bit rotation is a product modulo 2^32 - 1.
    """
    m = f"{draws.MASK}::UBIGINT"

    def times(x: str, factor: int, plus: int = 0) -> str:
        return f"(({x} * {factor}::UBIGINT + {plus}::UBIGINT) & {m})"

    def rotl(x: str, r: int) -> str:
        return f"(({x} * {1 << r}::UBIGINT) % {m})"

    def half(key: str, part: str) -> str:
        bits = f"({key}::BIGINT & {draws.MASK})" if part == "lo" else f"({key}::BIGINT >> 32)"
        k = times(rotl(times(f"{bits}::UBIGINT", 0xCC9E2D51), 15), 0x1B873593)
        return f"{k} AS _{part}_{key}"

    halves = [half(k, part) for k in keys for part in ("lo", "hi")]
    start = [f"{_murmur(42, draws.salt_of(n, SEED))}::UBIGINT AS {n}" for n in names]
    sql = f"SELECT *, {', '.join(halves + start)} FROM {source}"

    def level(cell) -> None:
        nonlocal sql
        sql = f"SELECT * REPLACE ({', '.join(f'{cell(n)} AS {n}' for n in names)}) FROM ({sql})"

    for key in keys:
        for part in ("lo", "hi"):
            level(lambda n: times(rotl(f"xor({n}, _{part}_{key})", 13), 5, 0xE6546B64))
        level(lambda n: f"xor({n}, 8::UBIGINT)")
        level(lambda n: times(f"xor({n}, {n} >> 16)", 0x85EBCA6B))
        level(lambda n: times(f"xor({n}, {n} >> 13)", 0xC2B2AE35))
        level(lambda n: f"xor({n}, {n} >> 16)")
    level(lambda n: f"({n}::DOUBLE + 0.5::DOUBLE) / 4294967296.0::DOUBLE")
    helpers = ", ".join(f"_{part}_{key}" for key in keys for part in ("lo", "hi"))
    return f"SELECT * EXCLUDE ({helpers}) FROM ({sql})"


def _text(value: object) -> str:
    return f"'{value}'" if isinstance(value, str) else str(value)


def _choice(u: str, values: Sequence[object], weights: Sequence[float]) -> str:
    total, arms = 0.0, []
    for v, w in zip(values[:-1], weights[:-1]):
        total = round(total + w, 12)
        arms.append(f"WHEN {u} < {total}::DOUBLE THEN {_text(v)}")
    return f"CASE {' '.join(arms)} ELSE {_text(values[-1])} END"


def _pick(u: str, values: Sequence[object]) -> str:
    return f"[{', '.join(map(_text, values))}][FLOOR({u} * {len(values)})::INTEGER + 1]"


def _integer(u: str, low: int, high: int) -> str:
    return f"(FLOOR({u} * {high - low}.0::DOUBLE) + {low})::INTEGER"


def _clip(x: str, low: int, high: int) -> str:
    return f"TRUNC(LEAST(GREATEST({x}, {low}.0::DOUBLE), {high}.0::DOUBLE))::INTEGER"


def _between(u: str, low: str, high: str) -> str:
    return f"({low}::DOUBLE + {u} * ({high}::DOUBLE - {low}::DOUBLE))"


def _days(u: str, low: int, high: int) -> str:
    return f"({_integer(u, low, high)})"


_USER_DRAWS = ("user_signup", "user_plan", "user_age", "user_region", "user_device")
_USERS = f"""u_ AS (SELECT *, ({_TODAY} - TRUNC(720.0::DOUBLE - 720.0::DOUBLE * sqrt(user_signup))::INTEGER)::DATE AS signup_date
FROM ({_uniforms('(SELECT c_custkey AS n FROM customer)', ['n'], _USER_DRAWS)}))"""
_PLAN = _choice("user_plan", g.PLANS, g.PLAN_SHARES)
_PLAN_DRAWS = ("plan_weight", "plan_none", "plan_inactive", "plan_back", "plan_recent")
_EVENT_PLAN = f"""{_USERS}, w_ AS (SELECT *, FLOOR(pow(plan_weight, -1.0::DOUBLE / 1.4::DOUBLE) * 65536.0::DOUBLE)::BIGINT AS w
FROM ({_uniforms('(SELECT n, signup_date FROM u_)', ['n'], _PLAN_DRAWS)})),
rate AS (SELECT COUNT(*) * 50.0::DOUBLE / SUM(w)::DOUBLE AS per_weight FROM w_),
p_ AS (SELECT n, CASE WHEN plan_none < 0.05::DOUBLE THEN 0
ELSE GREATEST(round_even(w * per_weight, 0)::BIGINT, 1) END AS k,
date_diff('day', signup_date, {_TODAY})::INTEGER AS signup_age, plan_inactive < 0.3::DOUBLE AS inactive,
plan_inactive < 0.3::DOUBLE AND plan_back < 0.25::DOUBLE AS reactivates,
{_integer('plan_recent', 1, 4)} AS n_recent, GREATEST(LEAST(date_diff('day', signup_date, {_TODAY}), 720), 1) AS oldest
FROM w_ JOIN rate ON TRUE),
f_ AS (SELECT *, unnest(range(1, k + 1)) AS i FROM p_ WHERE k > 0)"""
_PEAK = f"""peak AS (SELECT list(d ORDER BY d) AS days FROM range(0, 721) t(d)
WHERE month({_TODAY} - d::INTEGER) IN (12, 1, 7))"""
_EVENT_DAYS = f"""{_EVENT_PLAN}, {_PEAK},
d_ AS ({_uniforms('f_', ['n', 'i'], g.EVENT_DRAWS)}),
o_ AS (SELECT *, CASE WHEN reactivates AND i <= LEAST(n_recent, k) THEN {_between('event_offset', '0', 'LEAST(oldest, 29)')}
WHEN inactive THEN {_between('event_offset', 'LEAST(60, oldest - 1)', 'oldest')}
WHEN i <= k // 2 THEN {_between('event_offset', '0', 'LEAST(90, oldest)')}
ELSE {_between('event_offset', '0', 'oldest')} END AS offset_days FROM d_),
e_ AS (SELECT o_.*, (CASE WHEN event_shift < 0.1::DOUBLE
THEN LEAST(days[FLOOR(event_shift_day * len(days))::INTEGER + 1], GREATEST(signup_age, 0))
ELSE TRUNC(offset_days) END)::INTEGER AS days_ago FROM o_ JOIN peak ON TRUE)"""


def _progress(mix: str, u: str) -> str:
    return (f"CASE WHEN {mix} < 0.45::DOUBLE THEN {_between(u, '0.0', '0.1')} "
            f"WHEN {mix} < 0.7::DOUBLE THEN {_between(u, '0.95', '1.0')} ELSE {_between(u, '0.1', '0.95')} END")


def _session(u1: str, u2: str) -> str:
    return _clip(f"-15.0::DOUBLE * ln({u1} * {u2})", 1, 180)


def _rating(rated: str, value: str) -> str:
    return f"CASE WHEN {rated} < 0.2::DOUBLE THEN {_choice(value, g.RATINGS, g.RATING_SHARES)} END"


def user_keys(spark: SparkSession, root: str) -> DataFrame:
    return views.raw(spark, root, "customer").select(F.col("c_custkey").alias("n"))


def book_keys(spark: SparkSession, root: str) -> DataFrame:
    return views.raw(spark, root, "part").select(F.col("p_partkey").alias("n"))


def _lines(spark: SparkSession, root: str, *names: str) -> DataFrame:
    """One row per line item with draws keyed by order and line."""
    lines = views.raw(spark, root, "lineitem").select("l_orderkey", "l_linenumber")
    return draws.with_uniforms(lines, ["l_orderkey", "l_linenumber"], names, SEED)


def _line_sql(cells: str, *names: str) -> str:
    source = "(SELECT l_orderkey, l_linenumber FROM lineitem)"
    return f"SELECT l_orderkey, l_linenumber, {cells} FROM ({_uniforms(source, ['l_orderkey', 'l_linenumber'], names)})"


@query(f"SELECT n, u_one, u_two FROM ({_uniforms('(SELECT c_custkey AS n FROM customer)', ['n'], ['u_one', 'u_two'])})")
def gen_uniform(spark: SparkSession, root: str) -> DataFrame:
    return draws.with_uniforms(user_keys(spark, root), ["n"], ["u_one", "u_two"], SEED)


@query(_line_sql(f"{_choice('u', g.REGIONS, g.REGION_SHARES)} AS region", "u"))
def gen_weighted_choice(spark: SparkSession, root: str) -> DataFrame:
    region = draws.choice(F.col("u"), g.REGIONS, g.REGION_SHARES)
    return _lines(spark, root, "u").select("l_orderkey", "l_linenumber", region.alias("region"))


@query(f"WITH {_USERS} SELECT n, 720.0::DOUBLE * sqrt(user_signup) AS offset_days, signup_date FROM u_")
def gen_triangular(spark: SparkSession, root: str) -> DataFrame:
    drawn = g.user_draws(user_keys(spark, root), TODAY, SEED)
    offset = draws.right_triangular(F.col("user_signup"), g.WINDOW_DAYS)
    return drawn.select("n", offset.alias("offset_days"), "signup_date")


_NORMAL = ("520.0::DOUBLE + 260.0::DOUBLE * sqrt(-2.0::DOUBLE * ln({0})) "
           "* cos(6.283185307179586::DOUBLE * {1})")


@query(_line_sql(f"{_clip(_NORMAL.format('u1', 'u2'), 60, 1500)} AS length_minutes", "u1", "u2"))
def gen_clipped_normal(spark: SparkSession, root: str) -> DataFrame:
    length = g.book_length(F.col("u1"), F.col("u2"))
    return _lines(spark, root, "u1", "u2").select(
        "l_orderkey", "l_linenumber", length.alias("length_minutes")
    )


@query(_line_sql(f"{_session('u1', 'u2')} AS session_minutes", "u1", "u2"))
def gen_gamma_sessions(spark: SparkSession, root: str) -> DataFrame:
    minutes = g.session_minutes(F.col("u1"), F.col("u2"))
    return _lines(spark, root, "u1", "u2").select(
        "l_orderkey", "l_linenumber", minutes.alias("session_minutes")
    )


@query(f"SELECT *, progress_pct >= 0.95::DOUBLE AS finished FROM ({_line_sql(_progress('mix', 'u') + ' AS progress_pct', 'mix', 'u')})")
def gen_mixture_progress(spark: SparkSession, root: str) -> DataFrame:
    drawn = _lines(spark, root, "mix", "u").select(
        "l_orderkey", "l_linenumber", g.progress(F.col("mix"), F.col("u")).alias("progress_pct")
    )
    return drawn.withColumn("finished", F.col("progress_pct") >= 0.95)


@query(_line_sql(f"{_rating('rated', 'stars')} AS rating", "rated", "stars"))
def gen_sparse_rating(spark: SparkSession, root: str) -> DataFrame:
    return _lines(spark, root, "rated", "stars").select(
        "l_orderkey", "l_linenumber", g.rating(F.col("rated"), F.col("stars")).alias("rating")
    )


@query(f"WITH {_EVENT_PLAN} SELECT n, k, i FROM f_")
def gen_pareto_fanout(spark: SparkSession, root: str) -> DataFrame:
    return g.fan_out(g.event_plan(user_keys(spark, root), TODAY)).select("n", "k", "i")


@query(f"WITH {_EVENT_DAYS} SELECT n, i, inactive, reactivates, ROUND(offset_days, 9) AS offset_days FROM e_")
def gen_activity_profiles(spark: SparkSession, root: str) -> DataFrame:
    return g.event_days(user_keys(spark, root), TODAY).select(
        "n", "i", "inactive", "reactivates", F.round("offset_days", 9).alias("offset_days")
    )


@query(f"WITH {_EVENT_DAYS} SELECT n, i, event_shift < 0.1::DOUBLE AS shifted, days_ago FROM e_")
def gen_seasonal_shift(spark: SparkSession, root: str) -> DataFrame:
    shifted = (F.col("event_shift") < g.SHIFTED_SHARE).alias("shifted")
    return g.event_days(user_keys(spark, root), TODAY).select("n", "i", shifted, "days_ago")


_BOOK_NAMES = ("adjective", "noun", "number", "genre", "format", "length_1", "length_2", "language")
_BOOKS = f"""SELECT 'b_' || lpad(n::VARCHAR, GREATEST(5, len(n::VARCHAR))::INTEGER, '0') AS book_id,
'O ' || {_pick('book_adjective', g.ADJECTIVES)} || ' ' || {_pick('book_noun', g.NOUNS)} || ' '
|| {_integer('book_number', 1, 9999)} AS title,
{_choice('book_genre', g.GENRES, g.GENRE_SHARES)} AS genre, {_choice('book_format', g.FORMATS, g.FORMAT_SHARES)} AS format,
{_clip(_NORMAL.format('book_length_1', 'book_length_2'), 60, 1500)} AS length_minutes,
{_choice('book_language', g.LANGUAGES, g.LANGUAGE_SHARES)} AS language
FROM ({_uniforms('(SELECT p_partkey AS n FROM part)', ['n'], [f'book_{c}' for c in _BOOK_NAMES])})"""


@query(_BOOKS)
def gen_books(spark: SparkSession, root: str) -> DataFrame:
    return g.books(book_keys(spark, root))


_USER_ID = "'u_' || lpad(n::VARCHAR, GREATEST(6, len(n::VARCHAR))::INTEGER, '0')"


@query(f"""WITH {_USERS} SELECT {_USER_ID} AS user_id, signup_date, {_PLAN} AS plan_type,
{_choice('user_age', g.AGE_BANDS, g.AGE_SHARES)} AS age_band,
{_choice('user_region', g.REGIONS, g.REGION_SHARES)} AS region,
{_choice('user_device', g.DEVICES, g.DEVICE_SHARES)} AS device_type FROM u_""")
def gen_users(spark: SparkSession, root: str) -> DataFrame:
    return g.users(user_keys(spark, root), TODAY)


@query(f"""WITH {_EVENT_DAYS}, b_ AS (SELECT {_USER_ID} AS user_id,
FLOOR(event_book * (SELECT COUNT(*) FROM part)::DOUBLE)::BIGINT AS b,
({_TODAY} - days_ago)::TIMESTAMP + to_hours({_integer('event_hour', 0, 24)}) + to_minutes({_integer('event_minute', 0, 60)})
+ to_seconds({_integer('event_second', 0, 60)}) AS event_ts,
{_progress('event_mix', 'event_progress')} AS progress_pct, {_session('event_session_1', 'event_session_2')} AS session_minutes,
{_rating('event_rated', 'event_rating')} AS rating FROM e_)
SELECT user_id, 'b_' || lpad(b::VARCHAR, GREATEST(5, len(b::VARCHAR))::INTEGER, '0') AS book_id, event_ts, progress_pct,
session_minutes, progress_pct >= 0.95::DOUBLE AS finished, rating FROM b_""")
def gen_events(spark: SparkSession, root: str) -> DataFrame:
    events = g.reading_events(user_keys(spark, root), book_keys(spark, root), TODAY)
    # The oracle states the wall clock in the drawing zone, whatever the session's zone is.
    clock = F.expr("timestamp_ntz '1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, unix_seconds(event_ts))")
    return events.withColumn("event_ts", clock)


def _subscription_sql() -> str:
    parts = ("gap", "back", "cancel", "length", "reason")
    names = ["sub_count", *[f"sub_{p}_{s}" for s in (1, 2, 3) for p in parts]]
    text = f"""WITH {_USERS}, s0 AS (SELECT *, {_choice('sub_count', (1, 2, 3), g.SUBSCRIPTION_COUNT_SHARES)} AS wanted,
signup_date AS end_0, TRUE AS go_0 FROM ({_uniforms(f"(SELECT n, signup_date FROM u_ WHERE {_PLAN} = 'premium')", ['n'], names)}))"""
    for s in (1, 2, 3):
        planned = f"(end_{s - 1} + {_days(f'sub_gap_{s}', 0, 30)})"
        text += f""", s{s} AS (SELECT *, end_{s} IS NOT NULL AS go_{s} FROM (SELECT *,
CASE WHEN sub_cancel_{s} < 0.3::DOUBLE AND start_{s} IS NOT NULL
THEN LEAST((start_{s} + {_days(f'sub_length_{s}', 30, 540)})::DATE, {_TODAY}) END AS end_{s} FROM (SELECT *,
CASE WHEN go_{s - 1} AND wanted >= {s} THEN CASE WHEN {planned} > {_TODAY} THEN ({_TODAY} - {_days(f'sub_back_{s}', 1, 30)})::DATE
ELSE {planned}::DATE END END AS start_{s} FROM s{s - 1})))"""
    rows = " UNION ALL ".join(
        f"""SELECT {_USER_ID} AS user_id, start_{s} AS start_date, end_{s} AS end_date,
CASE WHEN end_{s} IS NOT NULL THEN {_pick(f'sub_reason_{s}', g.CANCEL_REASONS)} END AS cancel_reason
FROM s3 WHERE start_{s} IS NOT NULL""" for s in (1, 2, 3))
    return f"{text} {rows}"


@query(_subscription_sql())
def gen_subscriptions(spark: SparkSession, root: str) -> DataFrame:
    return g.subscriptions(user_keys(spark, root), TODAY)


_RULES = (
    "event_user_exists", "event_book_exists", "subscription_user_exists", "event_after_signup",
    "progress_range", "session_range", "rating_range", "finished_means_progress", "length_range",
    "period_order", "reason_means_end",
)


@query("SELECT unnest([" + ", ".join(f"'{r}'" for r in _RULES) + "]) AS rule, 0::BIGINT AS violations")
def gen_invariants(spark: SparkSession, root: str) -> DataFrame:
    ids, titles = user_keys(spark, root), book_keys(spark, root)
    # Two groupings read the events: write them once instead of generating them each time.
    events = materialised(g.reading_events(ids, titles, TODAY), "generated_events")
    return g.invariants(g.users(ids, TODAY), g.books(titles), events, g.subscriptions(ids, TODAY))
