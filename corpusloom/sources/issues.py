"""Issues as a data source: pages of a REST listing through an injected ``fetch`` (url -> decoded JSON)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

BODIES = "number int, line_no int, id long, source_kind string, body string"


def paged(fetch: Callable[[str], list[dict]], url: str, size: int = 100) -> Iterator[dict]:
    page = 1
    while rows := fetch(f"{url}{'&' if '?' in url else '?'}per_page={size}&page={page}"):
        yield from rows
        page += 1


def bodies(spark: SparkSession, fetch: Callable[[str], list[dict]], repo_url: str, numbers: list[int] | None = None) -> DataFrame:
    """Bodies of issues (all open ones, pull requests left out, unless numbered) and their comments, in order."""
    issues = [fetch(f"{repo_url}/issues/{n}") for n in numbers] if numbers else [i for i in paged(fetch, f"{repo_url}/issues?state=open") if "pull_request" not in i]
    rows = []
    for i in issues:
        rows.append((i["number"], 0, i.get("id"), "issue", i.get("body") or ""))
        rows += [(i["number"], k, c.get("id"), "comment", c.get("body") or "") for k, c in enumerate(paged(fetch, f"{repo_url}/issues/{i['number']}/comments"), 1)]
    return spark.createDataFrame(rows, BODIES)
