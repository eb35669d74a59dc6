"""Where everything lives: drop folders, layers, checkpoints, published names."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.domains import DOMAINS, SPARK_TYPES, Domain
from wardflow.operators import scd2
from wardflow.operators.masking import masked
from wardflow.plans import kpis
from wardflow.plans.facts import FACTS
from wardflow.sources import exception_log, folders
from wardflow.sources.tables import SegmentedTable

# ---------------------------------------------------------------------------
# Names under which users query the results.
# ---------------------------------------------------------------------------
DIMENSIONS = {"dim_patient": "patients", "dim_doctor": "doctors"}
KPI_VIEWS = {
    "bed_occ": lambda facts: kpis.bed_utilization(facts["admissions"]),
    "att": lambda facts: kpis.turnaround(facts["admissions"]),
    "surgey_efficiny": lambda facts: kpis.surgery_efficiency(facts["procedures"]),
    "kpi_doctor_workload": lambda facts: kpis.doctor_workload(facts["admissions"], facts["procedures"]),
    "kpi_data_quality": lambda facts: kpis.billing_accuracy(facts["billing"]),
}
# ---------------------------------------------------------------------------

# The role of a reader who names none.
NO_ROLE = "PUBLIC"

# Loads are numbered per landing generation, so that loads after a reset of the
# landing table count on from those before it.
LOADS_PER_GENERATION = 1_000_000_000


@dataclass
class Warehouse:
    """``root`` is a folder all executors share; ``drops`` maps a domain to its
    CSV folder and defaults to ``<root>/drops/<domain>``."""

    spark: SparkSession
    root: str
    drops: dict[str, str] = field(default_factory=dict)

    def drop_folder(self, name: str) -> str:
        return self.drops.get(name, f"{self.root}/drops/{name}")

    # ---- bronze --------------------------------------------------------

    def generation(self, name: str) -> int:
        made = folders.children(self.spark, f"{self.root}/bronze/{name}")
        return max((int(g.split("-")[1]) for g in made if g.startswith("gen-")), default=0)

    def landing_path(self, name: str) -> str:
        return f"{self.root}/bronze/{name}/gen-{self.generation(name)}"

    def checkpoint(self, stage: str, name: str) -> str:
        return f"{self.root}/_checkpoints/{stage}/{name}/gen-{self.generation(name)}"

    def reset_landing(self, name: str) -> None:
        """Empty the landing table. The files of the drop folder count as new again."""
        folders.make(self.spark, f"{self.root}/bronze/{name}/gen-{self.generation(name) + 1}")

    def has_landed(self, name: str) -> bool:
        return folders.exists(self.spark, f"{self.landing_path(name)}/_spark_metadata")

    def landing(self, name: str) -> DataFrame:
        """The landing table, arrival columns included."""
        schema = DOMAINS[name].landing_schema()
        if not self.has_landed(name):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.landing_path(name))

    def raw(self, name: str) -> DataFrame:
        """The landing table as delivered, plus ``load_time``."""
        return self.landing(name).select(*DOMAINS[name].column_names, "load_time")

    def malformed(self, name: str) -> DataFrame:
        """Delivered lines with too few or too many fields."""
        return self.landing(name).where("_corrupt_record IS NOT NULL")

    def _consumed_path(self, name: str) -> str:
        return f"{self.root}/bronze/{name}/consumed-{self.generation(name)}"

    def note_consumed(self, files: DataFrame, name: str, sequence: int) -> None:
        files.write.mode("overwrite").parquet(f"{self._consumed_path(name)}/load={sequence}")

    def pending(self, name: str) -> DataFrame:
        """Landing rows no load has consumed yet. Looking does not consume them.
        Loads consume whole files, so the names of the files decide."""
        landing = self.landing(name)
        columns = [*DOMAINS[name].column_names, "load_time"]
        if not self.has_landed(name) or not folders.exists(self.spark, self._consumed_path(name)):
            return landing.select(*columns)
        seen = self.spark.read.schema("landed_file string").parquet(self._consumed_path(name)).distinct()
        # Every landed file has a unique name, however the two listings spell its folder.
        rows = landing.withColumn("_landed", F.col("_metadata.file_name"))
        done = F.substring_index("landed_file", "/", -1)
        return rows.join(seen, F.col("_landed") == done, "left_anti").select(*columns)

    # ---- silver --------------------------------------------------------

    def silver_table(self, name: str) -> SegmentedTable:
        domain = DOMAINS[name]
        return SegmentedTable(
            self.spark,
            f"{self.root}/silver/{name}",
            domain.silver_schema(),
            domain.key,
        )

    def silver(self, name: str, role: str | None = None) -> DataFrame:
        """A silver table as loads read it; with a ``role`` given, personal columns as it may see them."""
        table, pii = self.silver_table(name).read(), DOMAINS[name].pii
        return table if role is None or not pii else masked(table, pii, role)

    @property
    def exceptions_path(self) -> str:
        return f"{self.root}/silver/exceptions"

    def exceptions(self) -> DataFrame:
        return exception_log.read_exceptions(self.spark, self.exceptions_path)

    # ---- gold ----------------------------------------------------------

    def fact_table(self, name: str) -> SegmentedTable:
        silver = self.silver_table(name)
        schema = FACTS[name](self.spark.createDataFrame([], silver.schema)).schema
        return SegmentedTable(self.spark, f"{self.root}/gold/fact_{name}", schema, silver.key)

    def fact(self, name: str) -> DataFrame:
        return self.fact_table(name).read()

    def _dim_schema(self, domain: Domain) -> T.StructType:
        fields = [T.StructField(c, SPARK_TYPES[kind]) for c, kind in domain.columns]
        return T.StructType(
            [
                *fields,
                T.StructField(scd2.START, T.DateType()),
                T.StructField(scd2.END, T.DateType()),
                T.StructField(scd2.FLAG, T.StringType()),
            ]
        )

    def dim_current(self, dim: str) -> SegmentedTable:
        """Current versions, replaced by every refresh."""
        domain = DOMAINS[DIMENSIONS[dim]]
        return SegmentedTable(
            self.spark, f"{self.root}/gold/{dim}/current", self._dim_schema(domain), domain.key
        )

    def dim_history(self, dim: str) -> SegmentedTable:
        """Closed versions, only ever added to."""
        domain = DOMAINS[DIMENSIONS[dim]]
        return SegmentedTable(
            self.spark, f"{self.root}/gold/{dim}/history", self._dim_schema(domain), domain.key
        )

    def dim(self, dim: str) -> DataFrame:
        """All versions. History counts up to the refresh that wrote the current rows."""
        current = self.dim_current(dim)
        return current.read().unionByName(self.dim_history(dim).read(before=current.last() + 1))

    def kpi(self, view: str) -> DataFrame:
        return KPI_VIEWS[view]({name: self.fact(name) for name in FACTS})

    # ---- names ---------------------------------------------------------

    def table_names(self) -> list[str]:
        names = [f"raw_{d}" for d in DOMAINS] + [f"raw_{d}_st" for d in DOMAINS]
        names += [f"silver_{d}" for d in DOMAINS] + ["exception_table"]
        return names + list(DIMENSIONS) + [f"fact_{d}" for d in FACTS] + list(KPI_VIEWS)

    def read_table(self, name: str, role: str | None = None) -> DataFrame:
        """Any table or view of any layer by its published name. Personal columns of
        the silver tables are masked unless ``role`` is an administrator's."""
        if name == "exception_table":
            return self.exceptions()
        if name in DIMENSIONS:
            return self.dim(name)
        if name in KPI_VIEWS:
            return self.kpi(name)
        layer, _, domain = name.partition("_")
        if layer == "raw" and domain.endswith("_st"):
            return self.pending(domain.removesuffix("_st"))
        if layer == "raw":
            return self.raw(domain)
        if layer == "silver":
            return self.silver(domain, role or NO_ROLE)
        if layer == "fact":
            return self.fact(domain)
        raise KeyError(name)

    def register_views(self, role: str | None = None) -> list[str]:
        """Publish everything as temporary views, for ``spark.sql``. A view shows
        the state at registration, masked for all but administrator roles; register
        again after a run."""
        names = self.table_names()
        for name in names:
            self.read_table(name, role).createOrReplaceTempView(name)
        return names
