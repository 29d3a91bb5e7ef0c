"""The registry of sources: a frame ``(name, url, job_count, producer_online)``.

It is passed in and handed back; nothing is kept in the module. ``RunningSources`` makes it from the queries
that run.
"""

from __future__ import annotations

from threading import Lock

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from fieldtally.functions import source_name, source_url

# The known sources.
_KNOWN_SOURCES = """
    SELECT name, url, 0 AS job_count, false AS producer_online
    FROM VALUES
        ('gbif', 'https://gbif.org'),
        ('obis', 'https://obis.org'),
        ('idigbio', 'https://idigbio.org')
    AS known(name, url)
"""


def known_sources(spark: SparkSession) -> DataFrame:
    """The sources before any of them has been started."""
    return spark.sql(_KNOWN_SOURCES)


def active_sources(registry: DataFrame) -> DataFrame:
    return registry.where(F.col("job_count") > 0)


def list_sources(registry: DataFrame) -> DataFrame:
    return active_sources(registry).select(source_url(F.col("name")).alias("source"))


def find_source(registry: DataFrame, url: str) -> str:
    """Name of the registered source behind a URL."""
    if not url:
        raise ValueError("a source URL is needed")
    match = registry.where(F.col("name") == source_name(F.lit(url))).select("name").first()
    if match is None:
        raise ValueError(f"no registered source for URL {url!r}")
    return match["name"]


def mark_started(registry: DataFrame, name: str, producer: bool = True) -> DataFrame:
    """The registry with one more job of the source, and its producer online if one was started."""
    started = F.col("name") == name
    job_count = F.col("job_count") + F.when(started, 1).otherwise(0)
    online = F.col("producer_online") | (started & F.lit(producer))
    return registry.withColumns({"job_count": job_count, "producer_online": online})


class RunningSources(StreamingQueryListener):
    """Which sources have jobs and producers running, from the life of their queries.

    A query that is watched counts until Spark reports its end, whether it was stopped, came to its end
    or failed; ``failures`` keeps the messages of those that failed.
    """

    def __init__(self, spark: SparkSession):
        self._lock = Lock()
        self._running: dict[str, tuple[str, bool]] = {}
        self._ended: set[str] = set()
        self.failures: list[tuple[str, str]] = []
        self._streams = spark.streams
        self._streams.addListener(self)

    def watch(self, name: str, query: StreamingQuery, producer: bool = False) -> None:
        """Count the query as a job of the source, or as its producer."""
        run = str(query.runId)
        with self._lock:
            # Its end may have been reported before it came here.
            if run not in self._ended:
                self._running[run] = name, producer

    def registry(self, known: DataFrame) -> DataFrame:
        """The known sources as they are now: running jobs, and whether a producer runs."""
        with self._lock:
            running = list(self._running.values())
        jobs, online = F.lit(0), F.lit(False)
        for name in {name for name, _ in running}:
            count = sum(1 for other, producer in running if other == name and not producer)
            jobs = F.when(F.col("name") == name, F.lit(count)).otherwise(jobs)
            online = F.when(F.col("name") == name, F.lit((name, True) in running)).otherwise(online)
        return known.withColumns({"job_count": jobs, "producer_online": online})

    def close(self) -> None:
        self._streams.removeListener(self)

    def onQueryTerminated(self, event) -> None:
        run = str(event.runId)
        with self._lock:
            self._ended.add(run)
            name, _ = self._running.pop(run, (None, False))
            if name is not None and event.exception:
                self.failures.append((name, event.exception))

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass
