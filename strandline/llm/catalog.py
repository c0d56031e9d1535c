"""The training-data queries by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strandline.llm import (
    centroid, chat, decontaminate, hosts, language, license, mixing, near, privacy, ranking, sharding, tokens, urls,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_license": license.op1_license,
        "op2_privacy": privacy.op2_privacy,
        "op3_tokens": tokens.op3_tokens,
        "op4_near_duplicates": near.op4_near_duplicates,
        "op5_urls": urls.op5_urls,
        "op6_mixing": mixing.op6_mixing,
        "op7_hosts": hosts.op7_hosts,
        "op8_sharding": sharding.op8_sharding,
        "op9_language": language.op9_language,
        "op10_decontaminate": decontaminate.op10_decontaminate,
        "op11_ranking": ranking.op11_ranking,
        "op12_chat": chat.op12_chat,
        "op13_centroids": centroid.op13_centroids,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op6_mixing": mixing.OP6_SQL,
        "op7_hosts": hosts.OP7_SQL,
        "op10_decontaminate": decontaminate.OP10_SQL,
        "op11_ranking": ranking.OP11_SQL,
        "op12_chat": chat.OP12_SQL,
        "op13_centroids": centroid.OP13_SQL,
    }
