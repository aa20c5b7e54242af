"""The shipped filter chains by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from crawlframe.schemas import DENY_RULES

# Hosts no URL may point to before a fetch.
LOCAL_HOSTS = ("localhost", "127.0.0.1")


def local_deny_rules(spark: SparkSession) -> DataFrame:
    rows = [(i, "host", host, "all", ".") for i, host in enumerate(LOCAL_HOSTS)]
    return spark.createDataFrame(rows, DENY_RULES)


def production(robots_rules: DataFrame | None = None, agent: str = "*") -> list[dict]:
    return [
        {"name": "max_depth", "params": {"n": -1}},
        {"name": "basic", "params": {"max_path_rep": 4, "max_len": 1024}},
        {"name": "normalize"},
        {"name": "regex"},
        {"name": "self"},
        {"name": "robots", "params": {"rules": robots_rules, "agent": agent}},
    ]


def pre_fetch(deny_rules: DataFrame) -> list[dict]:
    return [{"name": "deny", "params": {"rules": deny_rules}}]


def bootstrap() -> list[dict]:
    return [
        {"name": "normalize"},
        {"name": "host", "params": {"ignore_host": False, "ignore_domain": False}},
        {"name": "regex_normalize"},
        {"name": "regex"},
        {"name": "self"},
    ]


def inject() -> list[dict]:
    return [
        {"name": "max_depth", "params": {"n": -1}},
        {"name": "basic", "params": {"max_path_rep": 4, "max_len": 1024}},
        {"name": "normalize"},
        {"name": "regex_normalize"},
        {"name": "regex"},
        {"name": "self"},
    ]


PROFILES = {"production": production, "pre_fetch": pre_fetch, "bootstrap": bootstrap, "inject": inject}
