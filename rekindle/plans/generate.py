"""Synthetic users, books, reading events and subscriptions as distributed jobs.

Rows are drawn from seeded hashes of their own keys, so the tables are the same for any
number of partitions and a lost task recreates exactly its rows. All dates hang off
``today``. The key frames hold one integer column and may come from ``spark.range`` or
from an existing table.
"""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rekindle.contracts import N_EVENTS_TARGET, N_USERS, RANDOM_SEED
from rekindle.functions import draws
from rekindle.functions.scalars import clip_int, format_id

# Shares, ranges and word lists of the generated tables.
WINDOW_DAYS = 720
PLANS = ("free", "premium")
PLAN_SHARES = (0.70, 0.30)
AGE_BANDS = ("<25", "25-34", "35-44", "45-54", "55+")
AGE_SHARES = (0.18, 0.32, 0.25, 0.15, 0.10)
REGIONS = ("Norte", "Sul", "Sudeste", "Nordeste", "Centro-Oeste")
REGION_SHARES = (0.08, 0.15, 0.45, 0.22, 0.10)
DEVICES = ("mobile", "tablet", "desktop")
DEVICE_SHARES = (0.60, 0.25, 0.15)
ADJECTIVES = (
    "Silencioso", "Eterno", "Brilhante", "Oculto", "Antigo",
    "Distante", "Profundo", "Sereno", "Luminoso", "Selvagem",
)
NOUNS = (
    "Caminho", "Sonho", "Horizonte", "Mistério", "Oceano",
    "Jardim", "Reino", "Eco", "Refúgio", "Labirinto",
)
GENRES = (
    "Ficção", "Não-ficção", "Romance", "Suspense",
    "Fantasia", "Biografia", "Autoajuda", "Negócios",
)
GENRE_SHARES = (0.18, 0.14, 0.16, 0.13, 0.12, 0.10, 0.10, 0.07)
FORMATS = ("ebook", "audiobook")
FORMAT_SHARES = (0.60, 0.40)
LANGUAGES = ("pt", "en", "es")
LANGUAGE_SHARES = (0.78, 0.16, 0.06)
LENGTH_MEAN, LENGTH_SD, LENGTH_RANGE = 520.0, 260.0, (60, 1500)
SESSION_SCALE, SESSION_RANGE = 15.0, (1, 180)
PARETO_SHAPE = 1.4
NO_ACTIVITY_SHARE = 0.05
INACTIVE_SHARE = 0.30
REACTIVATED_SHARE = 0.25
SHIFTED_SHARE = 0.10
PEAK_MONTHS = (12, 1, 7)
RATED_SHARE = 0.20
RATINGS = (1, 2, 3, 4, 5)
RATING_SHARES = (0.05, 0.07, 0.18, 0.35, 0.35)
SUBSCRIPTION_COUNTS = (1, 2, 3)
SUBSCRIPTION_COUNT_SHARES = (0.80, 0.15, 0.05)
CANCELED_SHARE = 0.30
CANCEL_REASONS = (
    "preço", "pouco uso", "trocou de plataforma",
    "conteúdo insuficiente", "problema técnico", "outro",
)

EVENTS_PER_USER = N_EVENTS_TARGET // N_USERS
# Pareto weights are held as integers of this resolution: their sum is then exact and
# the same for every partitioning.
WEIGHT_SCALE = 65536.0


def keys(spark: SparkSession, n: int) -> DataFrame:
    """Key frame ``0 .. n-1`` in column ``n``."""
    return spark.range(n).withColumnRenamed("id", "n")


def user_draws(ids: DataFrame, today: date, seed: int) -> DataFrame:
    drawn = draws.with_uniforms(
        ids, ["n"], ["user_signup", "user_plan", "user_age", "user_region", "user_device"], seed
    )
    age = F.lit(float(WINDOW_DAYS)) - draws.right_triangular(F.col("user_signup"), WINDOW_DAYS)
    return drawn.withColumn("signup_date", F.date_sub(F.lit(today), age.cast("int")))


def users(ids: DataFrame, today: date, seed: int = RANDOM_SEED) -> DataFrame:
    """User table; signups become denser towards ``today``."""
    return user_draws(ids, today, seed).select(
        format_id("u_", 6, F.col("n")).alias("user_id"),
        "signup_date",
        draws.choice(F.col("user_plan"), PLANS, PLAN_SHARES).alias("plan_type"),
        draws.choice(F.col("user_age"), AGE_BANDS, AGE_SHARES).alias("age_band"),
        draws.choice(F.col("user_region"), REGIONS, REGION_SHARES).alias("region"),
        draws.choice(F.col("user_device"), DEVICES, DEVICE_SHARES).alias("device_type"),
    )


def book_length(u1: Column, u2: Column) -> Column:
    return clip_int(draws.normal(u1, u2, LENGTH_MEAN, LENGTH_SD), *LENGTH_RANGE)


def books(ids: DataFrame, seed: int = RANDOM_SEED) -> DataFrame:
    names = ["adjective", "noun", "number", "genre", "format", "length_1", "length_2", "language"]
    drawn = draws.with_uniforms(ids, ["n"], [f"book_{c}" for c in names], seed)
    u = {c: F.col(f"book_{c}") for c in names}
    return drawn.select(
        format_id("b_", 5, F.col("n")).alias("book_id"),
        F.concat_ws(
            " ",
            F.lit("O"),
            draws.pick(u["adjective"], ADJECTIVES),
            draws.pick(u["noun"], NOUNS),
            draws.integer(u["number"], 1, 9999).cast("string"),
        ).alias("title"),
        draws.choice(u["genre"], GENRES, GENRE_SHARES).alias("genre"),
        draws.choice(u["format"], FORMATS, FORMAT_SHARES).alias("format"),
        book_length(u["length_1"], u["length_2"]).alias("length_minutes"),
        draws.choice(u["language"], LANGUAGES, LANGUAGE_SHARES).alias("language"),
    )


def event_plan(
    ids: DataFrame, today: date, events_per_user: float = EVENTS_PER_USER, seed: int = RANDOM_SEED
) -> DataFrame:
    """Per user: number of events ``k``, days since signup, and activity profile.

    ``k`` is the user's Pareto share of all events; the total weight is one scalar
    subquery over the keys. Some users get none, every other user at least one.
    """
    names = ["plan_weight", "plan_none", "plan_inactive", "plan_back", "plan_recent"]
    drawn = draws.with_uniforms(user_draws(ids, today, seed).select("n", "signup_date"), ["n"], names, seed)
    weight = F.floor(draws.pareto(F.col("plan_weight"), PARETO_SHAPE) * F.lit(WEIGHT_SCALE)).cast("long")
    weighted = drawn.withColumn("w", weight)
    per_weight = weighted.agg(
        F.count(F.lit(1)) * F.lit(float(events_per_user)) / F.sum("w")
    ).scalar()
    share = F.rint(F.col("w") * per_weight).cast("long")
    inactive = F.col("plan_inactive") < INACTIVE_SHARE
    return weighted.select(
        "n",
        F.when(F.col("plan_none") < NO_ACTIVITY_SHARE, F.lit(0).cast("long"))
        .otherwise(F.greatest(share, F.lit(1)))
        .alias("k"),
        F.datediff(F.lit(today), "signup_date").alias("signup_age"),
        inactive.alias("inactive"),
        (inactive & (F.col("plan_back") < REACTIVATED_SHARE)).alias("reactivates"),
        draws.integer(F.col("plan_recent"), 1, 4).alias("n_recent"),
    )


#: Zone in which the drawn days and hours are read.
ZONE = "UTC"
#: Events that one task expands.
ROWS_PER_TASK = 1_000_000


def fan_out(plan: DataFrame, count: str = "k", ordinal: str = "i", events: float = 0) -> DataFrame:
    """One row per event: ordinals ``1 .. count`` for every row of the plan.

    ``events`` is about how many there will be; more of them go to more tasks.

    The Pareto tail gives single users a large part of all events. Each count is
    first cut into about sqrt(count) chunks, the chunks are spread over the cluster, and
    only then expanded, so no task unrolls a whole heavy user.
    """
    k = F.col(count)
    chunked = (
        plan.where(k > 0)
        .withColumn("_size", F.ceil(F.sqrt(k.cast("double"))))
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((k - 1) / F.col("_size")))))
    )
    first = F.col("_chunk") * F.col("_size") + 1
    last = F.least(first + F.col("_size") - 1, k)
    # A stated number of partitions: these few rows grow, so none may be merged away.
    least = int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(least, -(-int(events) // ROWS_PER_TASK))
    spread = chunked.repartition(tasks, F.col(plan.columns[0]), F.col("_chunk"))
    return spread.withColumn(ordinal, F.explode(F.sequence(first, last))).drop("_size", "_chunk")


def base_offset(u: Column) -> Column:
    """Age of an event in days before the seasonal shift, never older than the signup.

    Inactive users stay 60 or more days away, except for the few recent events of those
    who come back; half of an active user's events fall in the last 90 days.
    """
    oldest = F.greatest(F.least(F.col("signup_age"), F.lit(WINDOW_DAYS)), F.lit(1))
    come_back = F.col("reactivates") & (F.col("i") <= F.least(F.col("n_recent"), F.col("k")))
    return (
        F.when(come_back, draws.between(u, 0, F.least(oldest, F.lit(29)).cast("double")))
        .when(
            F.col("inactive"),
            draws.between(u, F.least(F.lit(60), oldest - 1).cast("double"), oldest.cast("double")),
        )
        .when(
            F.col("i") <= F.floor(F.col("k") / 2),
            draws.between(u, 0, F.least(F.lit(90), oldest).cast("double")),
        )
        .otherwise(draws.between(u, 0, oldest.cast("double")))
    )


def peak_offsets(today: date) -> list[int]:
    """Ages in days, within the window, that fall in a peak month."""
    return [d for d in range(WINDOW_DAYS + 1) if (today - timedelta(days=d)).month in PEAK_MONTHS]


def shifted_offset(offset: Column, u_shift: Column, u_day: Column, today: date) -> Column:
    """Move a tenth of the events to a peak month, but not before the signup."""
    peak = F.least(draws.pick(u_day, peak_offsets(today)), F.greatest(F.col("signup_age"), F.lit(0)))
    return F.when(u_shift < SHIFTED_SHARE, peak).otherwise(offset.cast("int"))


def progress(mix: Column, u: Column) -> Column:
    """45 % abandoned early, 25 % finished, the rest in between."""
    return (
        F.when(mix < 0.45, draws.between(u, 0.0, 0.10))
        .when(mix < 0.70, draws.between(u, 0.95, 1.00))
        .otherwise(draws.between(u, 0.10, 0.95))
    )


def session_minutes(u1: Column, u2: Column) -> Column:
    return clip_int(draws.gamma2(u1, u2, SESSION_SCALE), *SESSION_RANGE)


def rating(u_rated: Column, u_value: Column) -> Column:
    return F.when(u_rated < RATED_SHARE, draws.choice(u_value, RATINGS, RATING_SHARES))


EVENT_DRAWS = (
    "event_offset",
    "event_shift",
    "event_shift_day",
    "event_hour",
    "event_minute",
    "event_second",
    "event_book",
    "event_mix",
    "event_progress",
    "event_session_1",
    "event_session_2",
    "event_rated",
    "event_rating",
)


def event_days(
    ids: DataFrame, today: date, events_per_user: float = EVENTS_PER_USER, seed: int = RANDOM_SEED
) -> DataFrame:
    """One row per event with its draws and ``days_ago``."""
    # A count of keys reads no more than the keys; the plan itself runs once.
    rows = fan_out(event_plan(ids, today, events_per_user, seed), events=events_per_user * ids.count())
    drawn = draws.with_uniforms(rows, ["n", "i"], EVENT_DRAWS, seed)
    placed = drawn.withColumn("offset_days", base_offset(F.col("event_offset")))
    days = shifted_offset(
        F.col("offset_days"), F.col("event_shift"), F.col("event_shift_day"), today
    )
    return placed.withColumn("days_ago", days)


def reading_events(
    ids: DataFrame,
    book_ids: DataFrame,
    today: date,
    events_per_user: float = EVENTS_PER_USER,
    seed: int = RANDOM_SEED,
) -> DataFrame:
    """Event table; books are drawn uniformly from the keys ``0 .. count(book_ids) - 1``."""
    u = {c.removeprefix("event_"): F.col(c) for c in EVENT_DRAWS}
    n_books = book_ids.agg(F.count(F.lit(1)).cast("double")).scalar()
    rows = event_days(ids, today, events_per_user, seed).select(
        "n",
        F.floor(u["book"] * n_books).alias("book"),
        F.make_timestamp(
            years=F.year(F.date_sub(F.lit(today), F.col("days_ago"))),
            months=F.month(F.date_sub(F.lit(today), F.col("days_ago"))),
            days=F.day(F.date_sub(F.lit(today), F.col("days_ago"))),
            hours=draws.integer(u["hour"], 0, 24),
            mins=draws.integer(u["minute"], 0, 60),
            secs=draws.integer(u["second"], 0, 60),
            timezone=F.lit(ZONE),
        ).alias("event_ts"),
        progress(u["mix"], u["progress"]).alias("progress_pct"),
        session_minutes(u["session_1"], u["session_2"]).alias("session_minutes"),
        rating(u["rated"], u["rating"]).alias("rating"),
    )
    return rows.select(
        format_id("u_", 6, F.col("n")).alias("user_id"),
        format_id("b_", 5, F.col("book")).alias("book_id"),
        "event_ts",
        "progress_pct",
        "session_minutes",
        (F.col("progress_pct") >= 0.95).alias("finished"),
        "rating",
    )


def subscriptions(ids: DataFrame, today: date, seed: int = RANDOM_SEED) -> DataFrame:
    """Up to three chained periods per premium user; an active one ends the chain.

    The chain is a fold over three steps held in columns, so it stays one projection.
    """
    steps = SUBSCRIPTION_COUNTS
    parts = ("gap", "back", "cancel", "length", "reason")
    names = ["sub_count", *[f"sub_{p}_{s}" for s in steps for p in parts]]
    premium = user_draws(ids, today, seed).where(
        draws.choice(F.col("user_plan"), PLANS, PLAN_SHARES) == "premium"
    )
    chain = draws.with_uniforms(premium.select("n", "signup_date"), ["n"], names, seed)
    now = F.lit(today)
    chain = chain.withColumns(
        {
            "_wanted": draws.choice(F.col("sub_count"), steps, SUBSCRIPTION_COUNT_SHARES),
            "_end_0": F.col("signup_date"),
            "_go_0": F.lit(True),
        }
    )
    for s in steps:
        u = {p: F.col(f"sub_{p}_{s}") for p in parts}
        planned = F.date_add(f"_end_{s - 1}", draws.integer(u["gap"], 0, 30))
        chain = chain.withColumn(
            f"_start_{s}",
            F.when(
                F.col(f"_go_{s - 1}") & (F.col("_wanted") >= s),
                F.when(planned > now, F.date_sub(now, draws.integer(u["back"], 1, 30))).otherwise(planned),
            ),
        )
        finish = F.least(F.date_add(f"_start_{s}", draws.integer(u["length"], 30, 540)), now)
        # least() skips NULLs, so a period that never started must be ruled out by name.
        ends = F.col(f"_start_{s}").isNotNull() & (u["cancel"] < CANCELED_SHARE)
        chain = chain.withColumn(f"_end_{s}", F.when(ends, finish))
        chain = chain.withColumn(f"_go_{s}", F.col(f"_end_{s}").isNotNull())
    periods = [
        F.struct(
            F.col(f"_start_{s}").alias("start_date"),
            F.col(f"_end_{s}").alias("end_date"),
            F.when(
                F.col(f"_end_{s}").isNotNull(), draws.pick(F.col(f"sub_reason_{s}"), CANCEL_REASONS)
            ).alias("cancel_reason"),
        )
        for s in steps
    ]
    return (
        chain.select(format_id("u_", 6, F.col("n")).alias("user_id"), F.inline(F.array(*periods)))
        .where(F.col("start_date").isNotNull())
    )


def invariants(
    users_: DataFrame, books_: DataFrame, events: DataFrame, subs: DataFrame
) -> DataFrame:
    """Violations per rule of the generated tables; every count must be zero."""

    def rules(df: DataFrame, **broken: Column) -> DataFrame:
        """One row per rule, all from one aggregate of the table."""
        cells = [F.struct(F.lit(n).alias("rule"), F.count_if(c).alias("violations")) for n, c in broken.items()]
        return df.agg(F.array(*cells).alias("r")).select(F.inline("r"))

    p, minutes, stars = F.col("progress_pct"), F.col("session_minutes"), F.col("rating")
    # Per user and per book first: parents are joined to a row per key, not per event.
    by_user = events.groupBy("user_id").agg(
        F.min("event_ts").alias("first_ts"),
        F.count_if(~p.between(0, 1)).alias("progress"),
        F.count_if(~minutes.between(*SESSION_RANGE)).alias("session"),
        F.count_if(~stars.between(1, 5)).alias("stars"),
        F.count_if(F.col("finished") != (p >= 0.95)).alias("finished"),
    )
    known = users_.select("user_id", "signup_date")
    of_users = by_user.join(known.withColumn("_known", F.lit(True)), "user_id", "left").agg(
        F.count_if(F.col("_known").isNull()).alias("event_user_exists"),
        F.count_if(F.col("first_ts").cast("date") < F.col("signup_date")).alias("event_after_signup"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in (
            ("progress", "progress_range"), ("session", "session_range"), ("stars", "rating_range"),
            ("finished", "finished_means_progress"))],
    )
    names = of_users.columns
    of_events = of_users.select(
        F.inline(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in names]))
    )

    def orphans(df: DataFrame, parent: DataFrame, key: str, name: str) -> DataFrame:
        found = df.select(key).distinct().join(parent.select(key), key, "left_anti")
        return found.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("rule"), "violations")

    parts = [
        of_events,
        orphans(events, books_, "book_id", "event_book_exists"),
        orphans(subs, users_, "user_id", "subscription_user_exists"),
        rules(books_, length_range=~F.col("length_minutes").between(*LENGTH_RANGE)),
        rules(
            subs,
            period_order=F.col("end_date") < F.col("start_date"),
            reason_means_end=F.col("end_date").isNull() != F.col("cancel_reason").isNull(),
        ),
    ]
    return reduce(DataFrame.unionByName, parts)
