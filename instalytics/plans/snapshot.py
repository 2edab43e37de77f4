"""The snapshot sink: a partitioned Parquet table whose partitions a run replaces.

A run owns stated partitions and replaces all of them, empty ones too: what an
earlier run left there and this one did not write again is gone from the
table. Data files go into folders of their own, ``<partition>/run=<id>``,
which no reader looks at before the run is published; publishing is one new
file ``_versions/<n>.json`` that lists the live folders. A write that fails
leaves no version, so readers keep the old one. Two runs that publish at once
cannot both take a number: the later one reads the other's version and
publishes the next, with its own partitions replaced.

The folders of replaced runs stay until ``vacuum``, so a reader that opened
the version before can finish.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import files

RUN = "run"


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str, schema: StructType, partition_cols=("par_region", "par_process_date")):
        self.spark, self.path, self.schema, self.cols = spark, path.rstrip("/"), schema, list(partition_cols)

    # -- versions
    def _versions(self) -> list[int]:
        names = files.names(self.spark, f"{self.path}/_versions")
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def live(self) -> tuple[int, dict[str, str]]:
        """The last version and its folders: partition -> run id."""
        versions = self._versions()
        if not versions:
            return 0, {}
        return versions[-1], files.read_json(self.spark, f"{self.path}/_versions/{versions[-1]}.json")

    def _folder(self, values) -> str:
        if set(values) != set(self.cols):
            raise ValueError(f"a partition names {self.cols}, not {sorted(values)}")
        name = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
        return "/".join(name(c, None if values[c] is None else str(values[c])) for c in self.cols)

    # -- writing
    def replace(self, df: DataFrame, owned) -> int:
        """Replace the ``owned`` partitions (dicts of the partition columns) by
        ``df``; a row of another partition fails the run. Returns the version."""
        folders = [self._folder(o) for o in owned]
        run = uuid.uuid4().hex
        def named(value) -> str:
            return "?" if value is None else f"={value}"

        # null and text told apart; one comparison whatever the number of partitions
        place = F.concat_ws("/", *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("?")) for c in self.cols])
        mine = place.isin(["/".join(named(o[c]) for c in self.cols) for o in owned])
        stray = F.raise_error(F.concat_ws(" ", F.lit("row of a partition that the run does not own:"), *[F.col(c).cast("string") for c in self.cols]))
        first = self.cols[0]
        rows = df.select(*self.schema.fieldNames()).withColumn(first, F.when(mine, F.col(first)).otherwise(stray.cast(self.schema[first].dataType)))
        rows.withColumn(RUN, F.lit(run)).write.mode("append").partitionBy(*self.cols, RUN).parquet(self.path)
        written = {f for f in folders if files.exists(self.spark, f"{self.path}/{f}/{RUN}={run}")}
        while True:
            version, live = self.live()
            live = {f: r for f, r in live.items() if f not in folders} | {f: run for f in written}
            if files.publish_json(self.spark, f"{self.path}/_versions/{version + 1}.json", live):
                return version + 1

    def vacuum(self) -> int:
        """Delete the folders that the last version does not list (runs that
        were replaced or failed). Not while another run writes."""
        _, live = self.live()
        gone = 0
        for folder in self._partitions(self.path, len(self.cols)):
            for name in files.names(self.spark, f"{self.path}/{folder}"):
                if name.startswith(f"{RUN}=") and live.get(folder) != name[len(RUN) + 1:]:
                    files.delete(self.spark, f"{self.path}/{folder}/{name}")
                    gone += 1
        return gone

    def _partitions(self, path: str, depth: int) -> list[str]:
        if depth == 0:
            return [""]
        out = []
        for name in files.names(self.spark, path):
            if "=" in name and not name.startswith("_"):
                out += [f"{name}/{rest}".rstrip("/") for rest in self._partitions(f"{path}/{name}", depth - 1)]
        return out

    # -- reading
    def read(self) -> DataFrame:
        _, live = self.live()
        if not live:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.path}/{f}/{RUN}={r}" for f, r in sorted(live.items())]
        return self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*paths).select(*self.schema.fieldNames())
