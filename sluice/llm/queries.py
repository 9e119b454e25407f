"""The thin opN_<name> queries over the given tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sluice.llm import oracle
from sluice.llm.common import table
from sluice.llm.decontaminate import decontaminate
from sluice.llm.divergence import divergence_audit
from sluice.llm.hilbert import hilbert_shards
from sluice.llm.infill import digest, fill_in_middle, restore
from sluice.llm.langid import identify
from sluice.llm.maxent import score_documents
from sluice.llm.mixing import mix
from sluice.llm.pagetext import extract_pages
from sluice.llm.pii import find_personal_data
from sluice.llm.repetition import quality_rules
from sluice.llm.rollup import maintained_totals
from sluice.llm.simhash import near_duplicates
from sluice.llm.substrings import remove_repeats
from sluice.session import shared_dir


def op1_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op2_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op3_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash", "n_near")


def op3_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The proximity half of op3: benchmark windows with at least 8 of 10 words in place."""
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_near")


def op4_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_shards(table(spark, sf_dir, "documents"))


def op5_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"))


def op6_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintained_totals(table(spark, sf_dir, "documents"), shared_dir(spark, "rollup"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("copy_slots", "text_hash")


def op8_pagetext(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


def op11_maxent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence_audit(table(spark, sf_dir, "documents"))


def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    rebuilt = restore(fill_in_middle(table(spark, sf_dir, "documents")))
    return rebuilt.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest("output"), digest("restored"))


QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_repetition": (op1_repetition, oracle.REPETITION),
    "op2_ppm": (op2_ppm, None),
    "op3_index": (op3_index, oracle.DECONTAMINATION),
    "op3_proximity": (op3_proximity, None),
    "op4_hilbert": (op4_hilbert, None),
    "op5_boosting": (op5_boosting, None),
    "op6_rollup": (op6_rollup, None),
    "op7_mixing": (op7_mixing, oracle.MIXING),
    "op8_pagetext": (op8_pagetext, None),
    "op9_substrings": (op9_substrings, None),
    "op10_simhash": (op10_simhash, None),
    "op11_maxent": (op11_maxent, None),
    "op12_divergence": (op12_divergence, oracle.DIVERGENCE),
    "op13_infill": (op13_infill, oracle.INFILL),
}
