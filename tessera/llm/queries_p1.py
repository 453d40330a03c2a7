"""Prompts that look alike (p1)."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.lookalikes import canonical_texts, lookalike_classes, lookalike_pairs
from tessera.session import table


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return lookalike_pairs(table(spark, folder, "tasks"), "task_id", "raw_prompt")


def p1_canonical_prompts(spark: SparkSession, folder: str) -> DataFrame:
    tasks = table(spark, folder, "tasks").select("task_id", "raw_prompt").distinct()
    forms = canonical_texts(tasks, "raw_prompt").withColumnRenamed("text", "raw_prompt")
    return tasks.join(forms, "raw_prompt").select("task_id", "raw_prompt", "canonical")


def p1_classes(spark: SparkSession, folder: str) -> DataFrame:
    """A row per task and class of prompts that look the same, with the number of tasks it is tied to by another spelling."""
    return lookalike_classes(table(spark, folder, "tasks"), "task_id", "raw_prompt").select("task_id", "links")


# Fixed values, written out apart from the operator's tables: letters and signs of prompts beside those that look the same.
_ALIKE = ("АВЕКМНОРСТУХЅІЈаеорсухѕіјԛԝһӏѵΑΒΕΖΗΙΚΜΝΟΡΤΥΧονϲ‐‑−∕⁄µ", "ABEKMHOPCTYXSIJaeopcyxsijqwhlvABEZHIKMNOPTYXovc---//μ")
_BLANKS = "\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000\t"
_BARE = r"[\x{00AD}\x{034F}\x{061C}\x{180B}-\x{180E}\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{206F}\x{FE00}-\x{FE0F}\x{FEFF}\x{E0100}-\x{E01EF}]"
# Full-width forms and the radicals of Chinese characters, by their compatibility decomposition.
_WIDE = "".join(map(chr, [*range(0xFF01, 0xFF5F), *range(0x2F00, 0x2FD6)]))


def form_sql() -> str:
    """The form of a prompt in SQL: nothing without width, one width, blanks as spaces, look-alikes as Latin letters, composed."""
    old, new = _WIDE + _BLANKS + _ALIKE[0], unicodedata.normalize("NFKC", _WIDE) + " " * len(_BLANKS) + _ALIKE[1]
    said = lambda x: x.replace("'", "''")
    return f"nfc_normalize(translate(nfc_normalize(regexp_replace(raw_prompt, '{_BARE}', '', 'g')), '{said(old)}', '{said(new)}'))"


QUERIES = {"p1_found": p1_found, "p1_canonical_prompts": p1_canonical_prompts, "p1_classes": p1_classes}

SQL = {
    "p1_found": f"""WITH f AS (SELECT raw_prompt, {form_sql()} AS form FROM (SELECT DISTINCT raw_prompt FROM tasks WHERE raw_prompt IS NOT NULL)),
t AS (SELECT DISTINCT task_id, raw_prompt, form FROM tasks JOIN f USING (raw_prompt))
SELECT DISTINCT a.task_id AS task_id_a, b.task_id AS task_id_b FROM t a JOIN t b ON a.form = b.form AND a.task_id < b.task_id AND a.raw_prompt <> b.raw_prompt""",
    "p1_canonical_prompts": f"SELECT DISTINCT task_id, raw_prompt, {form_sql()} AS canonical FROM tasks WHERE raw_prompt IS NOT NULL",
    "p1_classes": f"""WITH f AS (SELECT raw_prompt, {form_sql()} AS form FROM (SELECT DISTINCT raw_prompt FROM tasks WHERE raw_prompt IS NOT NULL)),
t AS (SELECT DISTINCT task_id, raw_prompt, form FROM tasks JOIN f USING (raw_prompt) WHERE task_id IS NOT NULL)
SELECT a.task_id, count(DISTINCT b.task_id) AS links FROM t a JOIN t b ON a.form = b.form AND a.task_id <> b.task_id AND a.raw_prompt <> b.raw_prompt GROUP BY a.task_id, a.form""",
}
