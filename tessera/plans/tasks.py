"""Prompts to tasks: every prompt times every profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera import schemas
from tessera.functions.scalars import account, task_id
from tessera.operators.keys import numbered
from tessera.session import cut


#: Profiles up to which they travel in the plan; more are joined.
IN_PLAN = 1000
#: Rows of profiles (of some 50 bytes) that are broadcast at most; beyond there are enough blocks to shuffle by.
BROADCAST = 100_000


def task_table(prompts: DataFrame, profiles: DataFrame, accounts: Sequence[str] = schemas.ACCOUNTS) -> DataFrame:
    """Tasks of ``global_id, prompt_id, category, raw_prompt``: accounts in turn, an id of account, number and profile.

    Up to IN_PLAN profiles become an array in the plan that every prompt is exploded by: no join and no shuffle. More are cut into blocks of that many rows:
    prompts are repeated once a block and meet its rows by an equal join on the block's number, with the profiles broadcast up to BROADCAST of them."""
    columns = ("resolution", "width", "height", "num_frames", "frame_rate")
    held = profiles.select(*columns).limit(IN_PLAN + 1).collect()
    if len(held) > IN_PLAN:
        return _tasks_of(_met(prompts, profiles.select(*columns)), accounts)
    kinds = {f.name: f.dataType for f in profiles.schema.fields}
    array = F.array(*[F.struct(*[F.lit(r[c]).cast(kinds[c]).alias(c) for c in columns]) for r in held]).cast("array<struct<" + ",".join(f"{c}:{kinds[c].simpleString()}" for c in columns) + ">>")
    wide = prompts.select("global_id", "prompt_id", "category", "raw_prompt", F.explode(array).alias("_p")).select("global_id", "prompt_id", "category", "raw_prompt", "_p.*")
    return _tasks_of(wide, accounts)


def _met(prompts: DataFrame, profiles: DataFrame) -> DataFrame:
    placed = numbered(cut(profiles), "_number").withColumn("_block", F.floor(F.col("_number") / IN_PLAN)).drop("_number")
    blocks, n = placed.agg(F.max("_block"), F.count("*")).first()
    own = prompts.select("global_id", "prompt_id", "category", "raw_prompt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks).cast("bigint"))).alias("_block"))
    return own.join(F.broadcast(placed) if n <= BROADCAST else placed, "_block").drop("_block")


def _tasks_of(wide: DataFrame, accounts: Sequence[str]) -> DataFrame:
    own = account(F.col("global_id"), accounts)
    return wide.withColumn("account", own).withColumn("task_id", task_id(F.col("account"), F.col("global_id"), F.col("resolution"))).select(*schemas.columns(schemas.TASKS))


def load_by_account(tasks: DataFrame, resolutions: Sequence[str]) -> DataFrame:
    """Per account the tasks of each profile, all tasks and their frames."""
    of = [F.count_if(F.col("resolution") == r).alias(f"n_{r}") for r in resolutions]
    return tasks.groupBy("account").agg(*of, F.count("*").alias("tasks"), F.coalesce(F.sum(F.col("num_frames").cast("bigint")), F.lit(0)).alias("frames"))
