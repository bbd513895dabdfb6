"""Model calls over rows: cache, cost, budget, failures and self-consistency."""

from __future__ import annotations

import decimal
import hashlib
import threading
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import PRICES, UNKNOWN_PRICE
from ..functions.numbers import ratio
from ..functions.staging import Stage

# --- Calls --------------------------------------------------------------------


def _timed(call: Callable, texts: list[str], seconds: float | None):
    """The call's result; after that many seconds it is left to itself and counts as failed."""
    if seconds is None:
        return call(texts)
    box: list = []

    def run() -> None:
        try:
            box.append((call(texts), None))
        except Exception as error:  # noqa: BLE001 - raised again below
            box.append((None, error))

    thread = threading.Thread(target=run, daemon=True)
    thread.start()
    thread.join(seconds)
    if not box:
        raise TimeoutError(f"no answer within {seconds:g} s")
    answer, error = box[0]
    if error is not None:
        raise error
    return answer


def answer_all(
    scorer: Callable[[list[str]], list], texts: list[str], retries: int = 0, pause: float = 0.0, timeout: float | None = None
) -> list[tuple]:
    """(answer, reason, attempts) of every text, in their order.

    A scorer may put an exception in the place of a text that failed: the others keep their
    answers and only this text is asked again, up to `retries` times with growing pauses. If the whole
    call raises or gives another number of answers, its texts are asked again in halves until the
    one that fails stands alone.
    """
    out: list = [None] * len(texts)
    attempts = [0] * len(texts)
    # Places to ask for, and how often this group was retried as it is.
    groups = [(list(range(len(texts))), 0)]
    while groups:
        places, again = groups.pop()
        if not places:
            continue
        if again:
            time.sleep(pause * 2 ** (again - 1))
        for i in places:
            attempts[i] += 1
        try:
            answers = list(_timed(scorer, [texts[i] for i in places], timeout))
            if len(answers) != len(places):
                raise ValueError(f"{len(answers)} answers for {len(places)} prompts")
        except Exception as error:  # noqa: BLE001 - any failure marks rows, never the job
            if len(places) > 1:
                half = len(places) // 2
                groups += [(places[half:], again), (places[:half], again)]
                continue
            answers = [error]
        failed = []
        for i, answer in zip(places, answers):
            if isinstance(answer, BaseException) or answer is None:
                failed.append(i)
                reason = "no answer" if answer is None else f"{type(answer).__name__}: {answer}"
                out[i] = (None, reason, attempts[i])
            else:
                out[i] = (answer, None, attempts[i])
        if again < retries:
            groups.append((failed, again + 1))
    return out


def answer_in_order(
    scorer: Callable[[list[str]], list], texts: list[str], batch: int, in_flight: int, **options
) -> list[tuple]:
    """As `answer_all`, in calls of `batch` texts of which `in_flight` are open at a time."""
    parts = [texts[k : k + batch] for k in range(0, len(texts), batch)]
    if in_flight <= 1 or len(parts) <= 1:
        return [row for part in parts for row in answer_all(scorer, part, **options)]
    with ThreadPoolExecutor(in_flight) as pool:
        return [row for rows in pool.map(lambda part: answer_all(scorer, part, **options), parts) for row in rows]


def infer(
    df: DataFrame,
    make_scorer: Callable[[], Callable[[list[str]], list]],
    prompt: str = "prompt",
    batch: int = 50,
    in_flight: int = 1,
    tasks: int | None = None,
    retries: int = 0,
    pause: float = 0.0,
    timeout: float | None = None,
    keep_prompt: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Answer every prompt; return the answered rows and the failed ones.

    `make_scorer` is called once per task and returns a function from prompts to answers,
    which is called with up to `batch` prompts, from up to `in_flight` threads at a time. With
    `tasks` the prompts are dealt out to that many tasks, so a job has at most `tasks * in_flight`
    calls open. `answer_all` says what happens to prompts that fail; rows get `attempts`.
    Only the prompt column travels to Python, and without `keep_prompt` it is not written down. Calls cost money, so they are made when this
    function is called and the answers are written down once before they are split.
    """

    result = T.StructType(
        [
            T.StructField("response", T.StringType()),
            T.StructField("failed_reason", T.StringType()),
            T.StructField("attempts", T.IntegerType()),
        ]
    )
    options = {"retries": retries, "pause": pause, "timeout": timeout}

    @F.pandas_udf(result)
    def answer(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = make_scorer()
        for prompts in parts:
            rows = answer_in_order(scorer, list(prompts), batch, in_flight, **options)
            frame = pd.DataFrame(rows, columns=["response", "failed_reason", "attempts"], dtype=object)
            yield frame.astype({"attempts": "int32"})

    ask = answer.asNondeterministic()  # never copied or repeated by the optimizer
    dealt = df if tasks is None else df.repartition(tasks)
    kept = [c for c in df.columns if keep_prompt or c != prompt]
    scored = Stage(df.sparkSession, "answers").write(
        dealt.withColumn("_answer", ask(F.col(prompt))).select(*kept, "_answer.*")
    )
    failed = F.col("failed_reason").isNotNull()
    return scored.filter(~failed), scored.filter(failed)


# --- Cache --------------------------------------------------------------------


def cache_key(model: Column, prompt: Column, system: Column) -> Column:
    """Key of a call: the same model, prompt and instructions give the same answer."""
    return F.sha2(F.concat_ws("\x1f", model, prompt, system), 256)


def with_cache_key(df: DataFrame, system: str = "") -> DataFrame:
    return df.withColumn("cache_key", cache_key(F.col("model"), F.col("prompt"), F.lit(system)))


class AnswerCache:
    """Answers of earlier runs in a folder, bucketed by their key and partitioned by batch.

    Lookups read the buckets as they lie: only the rows that ask are shuffled. Each run adds its
    answers under a batch id, which holds a key once, so a run that is
    repeated after a failure appends nothing twice. The number of buckets is fixed when the
    folder is first used.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark = spark
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
        self.name = f"answers_{hashlib.md5(path.encode()).hexdigest()[:16]}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (cache_key STRING, response STRING, batch STRING) USING parquet "
            f"PARTITIONED BY (batch) CLUSTERED BY (cache_key) INTO {int(buckets)} BUCKETS LOCATION '{path}'"
        )
        self.buckets = buckets
        spark.catalog.recoverPartitions(self.name)

    def read(self) -> DataFrame:
        """All answers: cache_key, response, batch; a key may have several."""
        return self.spark.table(self.name)

    def add(self, batch: str, answers: DataFrame) -> None:
        """Store answers of a batch together with those it stored before, one per key."""
        if not batch.replace("-", "").replace("_", "").isalnum():
            raise ValueError(f"a batch id has letters, digits, '-' and '_': {batch!r}")
        new = answers.select("cache_key", "response").filter("cache_key IS NOT NULL AND response IS NOT NULL")
        old = self.read().filter(F.col("batch") == batch).select("cache_key", "response")
        stage = Stage(self.spark, "cache")
        rows = stage.write(new.unionByName(old).groupBy("cache_key").agg(F.min("response").alias("response")))
        view = f"{self.name}_{uuid.uuid4().hex}"
        rows.repartition(self.buckets, "cache_key").createOrReplaceTempView(view)
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.name} PARTITION (batch = '{batch}') SELECT cache_key, response FROM {view}")
        self.spark.catalog.dropTempView(view)
        stage.drop()


def split_cached(df: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows answered by the cache and rows that still need a call.

    A key that the cache holds more than once answers with its smallest response.
    """
    answers = cache.groupBy("cache_key").agg(F.min("response").alias("response"))
    looked_up = df.join(answers.withColumn("_known", F.lit(True)), "cache_key", "left")
    known = F.coalesce("_known", F.lit(False))
    return (
        looked_up.filter(known).drop("_known"),
        looked_up.filter(~known).drop("_known", "response"),
    )


def distinct_calls(misses: DataFrame) -> DataFrame:
    """One row per call to make; equal prompts share it."""
    return misses.groupBy("cache_key").agg(
        F.any_value("model").alias("model"), F.any_value("prompt").alias("prompt")
    )


# --- Cost ---------------------------------------------------------------------


def _price(model: Column, prices: dict, default: tuple, side: int) -> Column:
    value = F.lit(float(default[side]))
    for name, price in prices.items():
        value = F.when(model == name, F.lit(float(price[side]))).otherwise(value)
    return value


def cost_of(
    model: Column, tokens_in: Column, tokens_out: Column, prices=None, default=UNKNOWN_PRICE
) -> Column:
    """Price of a call (or of summed tokens of one model) in dollars."""
    prices = PRICES if prices is None else prices
    return (
        tokens_in * _price(model, prices, default, 0)
        + tokens_out * _price(model, prices, default, 1)
    ) / 1_000_000


def call_cost(calls: DataFrame, prices=None, default=UNKNOWN_PRICE) -> DataFrame:
    tokens = F.col("input_tokens"), F.col("output_tokens")
    return calls.withColumn("cost_usd", cost_of(F.col("model"), *tokens, prices, default))


def cost_breakdown(calls: DataFrame, prices=None, default=UNKNOWN_PRICE) -> DataFrame:
    """Calls and cost per model, priced from summed tokens so order cannot matter."""
    return (
        calls.groupBy("model")
        .agg(
            F.count(F.lit(1)).alias("calls"),
            F.sum("input_tokens").alias("input_tokens"),
            F.sum("output_tokens").alias("output_tokens"),
        )
        .withColumn(
            "cost_usd",
            cost_of(
                F.col("model"), F.col("input_tokens"), F.col("output_tokens"), prices, default
            ),
        )
    )


def running_cost(calls: DataFrame, order: list[str]) -> DataFrame:
    """Adds `spent_before`, the cost of all calls earlier in the order.

    A running total over all calls in one window would end in one task. The calls
    are range-partitioned on the order instead; every part gets its own running
    total and the sum of the parts before it. The parts are written down, when this
    function is called, before they are used twice: both uses see the same boundaries.
    """
    stage = Stage(calls.sparkSession, "budget")
    tasks = int(calls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = stage.write(
        calls.withColumn("_cost", F.col("cost_usd").cast("decimal(38,9)"))
        .repartitionByRange(tasks, *order)
        .withColumn("_part", F.spark_partition_id())
    )
    # One row per part.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        parts.groupBy("_part")
        .agg(F.sum("_cost").alias("_sum"))
        .select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    )
    earlier = (
        Window.partitionBy("_part")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    spent = F.col("_before") + F.coalesce(F.sum("_cost").over(earlier), F.lit(0))
    return (
        parts.join(F.broadcast(offsets), "_part")
        .withColumn("spent_before", spent.cast("decimal(38,9)"))
        .drop("_part", "_cost", "_before")
    )


def within_budget(calls: DataFrame, budget: float, order: list[str]) -> DataFrame:
    """Calls made before the money spent, as `cost_usd` has it, reaches the budget."""
    placed = running_cost(calls, order).filter(F.col("spent_before") < F.lit(budget))
    return placed.withColumn("spent_before", F.col("spent_before").cast("double"))


def tokens_of(text: Column) -> Column:
    """A quarter of the characters, where the model does not tell."""
    return F.ceil(F.length(text) / 4)


def infer_within_budget(
    calls: DataFrame,
    make_scorer: Callable[[], Callable[[list[str]], list]],
    budget: float,
    order: list[str],
    wave: float = 0.1,
    answer_tokens: Callable[[Column], Column] = tokens_of,
    prices=None,
    default=UNKNOWN_PRICE,
    prompts: Callable[[DataFrame], DataFrame] | None = None,
    **options,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Ask in waves until the money that was really spent reaches the budget.

    `calls` has model, prompt, input_tokens and output_tokens, an estimate. A wave releases calls
    in their order that are estimated at no more than `wave` times the budget, nor than
    what is left of it; when it is answered, the tokens of its answers say what it cost, and the
    next wave is released. So more is spent than allowed by at most what one wave costs beyond its
    estimate, and by its last call. Failed calls cost nothing. Returns the answered calls with their actual
    output_tokens and cost_usd, the failed calls and those never asked. With `prompts`, which adds the
    prompts to released calls, `calls` and what is returned have none, so that they are not moved
    with the plan of the waves. Runs jobs when called.
    """
    stage = Stage(calls.sparkSession, "waves")
    line = stage.write(running_cost(call_cost(calls, prices, default), order))
    place = F.col("spent_before")
    cursor, spent = decimal.Decimal(0), decimal.Decimal(0)
    limit = decimal.Decimal(str(budget))
    share = max(limit * decimal.Decimal(str(wave)), decimal.Decimal("1e-9"))
    answered, failed = [], []
    while spent < limit:
        start = line.filter(place >= F.lit(cursor)).agg(F.min(place)).first()[0]
        if start is None:
            break
        end = start + min(share, max(limit - spent, decimal.Decimal("1e-9")))
        released = line.filter((place >= F.lit(start)) & (place < F.lit(end)))
        if prompts is not None:
            released = prompts(released)
        good, bad = infer(released, make_scorer, keep_prompt=prompts is None, **options)
        good = stage.write(
            call_cost(good.withColumn("output_tokens", answer_tokens(F.col("response"))), prices, default)
        )
        spent += good.agg(F.sum(F.col("cost_usd").cast("decimal(38,9)"))).first()[0] or 0
        answered.append(good)
        failed.append(bad)
        cursor = end
    rest = line.filter(place >= F.lit(cursor)).drop("spent_before")
    nothing = line.limit(0).withColumns(
        {"response": F.lit(None).cast("string"), "failed_reason": F.lit(None).cast("string"), "attempts": F.lit(None).cast("int")}
    )
    join = lambda parts: reduce(DataFrame.unionByName, parts, nothing).drop("spent_before")
    return join(answered), join(failed), rest


# --- Self-consistency ---------------------------------------------------------


def sample_n(df: DataFrame, n: int = 100, seed: int = 42, key: str = "review_id") -> DataFrame:
    """n rows chosen by a hash of their key: the same ones on every run."""
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}")))
    return (
        df.withColumn("_digest", digest).orderBy("_digest", key).limit(n).drop("_digest")
    )


def verdict(rate: Column, good: float, fair: float | None = None) -> Column:
    worst = F.lit("FAIL") if fair is not None else F.lit("WARN")
    if fair is None:
        return F.when(rate >= good, "PASS").otherwise(worst)
    return F.when(rate >= good, "PASS").when(rate >= fair, "WARN").otherwise(worst)


def consistency(first: DataFrame, second: DataFrame, key: str = "review_id") -> DataFrame:
    """Agreement of two passes over the same reviews; two missing labels agree.

    A missing severity counts as 3.
    """
    a, b = first.alias("a"), second.alias("b")
    severity_gap = F.abs(
        F.coalesce("a.severity", F.lit(3)) - F.coalesce("b.severity", F.lit(3))
    )
    checks = {
        "primary_theme": F.col("a.primary_theme").eqNullSafe(F.col("b.primary_theme")),
        "sentiment": F.col("a.sentiment").eqNullSafe(F.col("b.sentiment")),
        "severity_exact": severity_gap == 0,
        "severity_within_1": severity_gap <= 1,
    }
    wide = a.join(b, key).agg(
        F.count(F.lit(1)).alias("sample_size"),
        *[F.sum(c.cast("long")).alias(n) for n, c in checks.items()],
    )
    pairs = F.array(
        *[F.struct(F.lit(n).alias("field"), F.col(n).alias("agreements")) for n in checks]
    )
    rate = ratio(F.col("agreements"), F.col("sample_size"))
    return (
        wide.select("sample_size", F.explode(pairs).alias("row"))
        .select("row.field", "sample_size", "row.agreements")
        .withColumn("rate", rate)
        .withColumn("status", verdict(rate, 0.8, 0.7))
    )
