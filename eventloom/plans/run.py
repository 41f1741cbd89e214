"""A whole pipeline (L2, L3): subjects first, then every table; a failing table does not stop the others."""

from __future__ import annotations

import hashlib
import logging
import math
from collections import Counter
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from eventloom.errors import SpecError
from eventloom.functions.columns import named
from eventloom.operators.cohort import SPLITS, code_metadata, cohort, dataset_metadata, events, read_splits, split_subjects, write_metadata
from eventloom.operators.layout import FILE_ROWS, dealt_by_subject, read_cohort, write_cohort
from eventloom.operators.shape import select_rename
from eventloom.operators.subjects import extend_id_map, known_patients, map_subjects, read_id_map, subject_ids
from eventloom.plans.lint import lint
from eventloom.plans.spec import FileSpec, PipelineSpec, TableSpec
from eventloom.plans.tables import compile_table, read_file, unwatched
from eventloom.sources.readers import FORMATS
from eventloom.sources.readers import file_format as file_format_of
from eventloom.sources.writers import save
from eventloom.work import cleared, materialised

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class TableReport:
    table: str
    status: str  # written, empty or failed
    rows: int | None
    message: str = ""
    stages: tuple[tuple[str, int | None], ...] = ()


class StageCounts:
    """Rows after each stage of a table's plan, counted by the job that writes the table.

    A count stands in the plan between two steps, so filters of later steps are not pushed past it.
    """

    def __init__(self):
        self.seen: dict[str, Observation] = {}

    def __call__(self, stage: str, df: DataFrame) -> DataFrame:
        self.seen[stage] = Observation()
        return df.observe(self.seen[stage], F.count(F.lit(1)).alias("rows"))

    def rows(self) -> tuple[tuple[str, int | None], ...]:
        """(stage, rows) in order, once the job is done; no number where execution left a stage out, as nothing came of it."""
        return tuple((stage, self._counted(seen)) for stage, seen in self.seen.items())

    @staticmethod
    def _counted(seen: Observation) -> int | None:
        try:
            return seen.get.get("rows")
        except Py4JJavaError:  # a count that adaptive execution left out has no values to read
            return None


def compile_subjects(spark: SparkSession, spec: PipelineSpec, raw: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(subject table with numbers, id map). Patients without an id are left out before numbering."""
    patients = raw if raw is not None else read_file(spark, spec.patients, list(spec.patients_rename))
    patients = known_patients(select_rename(patients, spec.patients_rename))
    id_map = subject_ids(patients, "subject_id")
    return map_subjects(patients, id_map), id_map


def shared_sides(spark: SparkSession, tables: Mapping[str, TableSpec]) -> dict[str, DataFrame]:
    """Delimited side files that lookups of several tables read, each parsed once, with all columns that any of them asks for.

    Parquet files are left as they are, as reading a few columns of one again costs little. A file that is not there, or lacks
    a column, is the matter of the tables that ask for it.
    """
    asked: dict[FileSpec, tuple[set[str], set[str]]] = {}
    for name, table in tables.items():
        for look in table.lookups:
            columns, users = asked.setdefault(look.file, (set(), set()))
            columns.update((look.key, *look.targets))
            users.add(name)
    paths = Counter(file.path for file in asked)
    out = {}
    for file, (columns, users) in asked.items():
        try:
            # one path that is read in two ways stays two files
            if len(users) > 1 and paths[file.path] == 1 and (FORMATS.get(file.file_format, file.file_format) or file_format_of(file.path)) == "csv":
                whole = read_file(spark, file)
                out[file.path] = materialised(whole.select(*(named(c) for c in whole.columns if c in columns)))
        except (AnalysisException, SpecError) as error:
            log.warning("side file %s: %s", file.path, str(error).splitlines()[0])
    return out


RECORD = "table string, status string, rows bigint, message string, stages array<struct<stage: string, rows: bigint>>, description string"


def described(*parts) -> str:
    """A digest of descriptions and settings; equal ones have equal digests."""
    return hashlib.sha256(repr(parts).encode()).hexdigest()


def recorded(spark: SparkSession, out: str, name: str, description: str) -> TableReport | None:
    """The report of a table that an earlier run has finished from the same description; None if there is none."""
    try:
        r = spark.read.schema(RECORD).json(f"{out}/reports/{name}").first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    if r is None or r["description"] != description:
        return None
    return TableReport(r["table"], r["status"], r["rows"], r["message"] or "", tuple((x["stage"], x["rows"]) for x in r["stages"] or ()))


def record(spark: SparkSession, out: str, report: TableReport, description: str) -> TableReport:
    row = (report.table, report.status, report.rows, report.message, list(report.stages), description)
    spark.createDataFrame([row], RECORD).coalesce(1).write.mode("overwrite").json(f"{out}/reports/{report.table}")
    return report


def run_pipeline(
    spark: SparkSession, spec: PipelineSpec, out: str, file_format: str = "parquet", mode: str = "overwrite", strict: bool = False, skip_empty: bool = False, test_rows: int | None = None,
    id_map: str | None = None, count_stages: bool = True, at_once: int = 1, resume: bool = False,
) -> list[TableReport]:
    """Write the id map, the subject table and every event table below ``out``; one report a table, with its rows after
    each stage unless ``count_stages`` is off.

    ``id_map`` names a map that outlives the run: ids in it keep their numbers, new ones are added (``extend_id_map``).
    Without it ids are numbered anew, which rows that are appended to earlier ones can't do with. So many tables as
    ``at_once`` says are written at the same time, which fills executors that small tables leave idle. With ``resume``, what
    an earlier run has finished from the same descriptions and ids is left as it is, and only the rest runs; it trusts that
    the raw files are the same. Reports of finished tables are kept in ``out``/reports for that.
    """
    if mode == "append" and not id_map:
        raise SpecError("rows are appended to those of other runs, so ids need the numbers of those: name an id_map")
    if mode == "append" and resume:
        raise SpecError("a run that appends can't be resumed: a table that failed half-way may have rows already")
    for warning in lint(spec):
        log.warning(warning)
    subjects = described(spec.patients, dict(spec.patients_rename), file_format, id_map)
    done = recorded(spark, out, "subject", subjects) if resume else None
    patients = known_patients(select_rename(read_file(spark, spec.patients, list(spec.patients_rename)), spec.patients_rename))
    if id_map:
        extend_id_map(patients, "subject_id", id_map)
        ids = read_id_map(spark, id_map)
        version = ids.agg(F.max("version")).first()[0]
    else:
        if not done:
            with cleared(spark):
                save(subject_ids(patients, "subject_id"), f"{out}/id_map", "parquet", "overwrite")
        ids, version = spark.read.parquet(f"{out}/id_map"), 0
    if done is None:
        done = record(spark, out, TableReport("subject", "written", save(map_subjects(patients, ids), f"{out}/subject", file_format, mode)), subjects)

    def one(name: str, table: TableSpec) -> TableReport:
        description = described(table, subjects, version, test_rows, skip_empty)
        found = recorded(spark, out, name, description) if resume else None
        if found and found.status in ("written", "empty"):
            return found
        try:
            counts = StageCounts() if count_stages else unwatched
            if skip_empty and compile_table(spark, table, ids, sides=sides, test_rows=test_rows).isEmpty():
                return record(spark, out, TableReport(name, "empty", None), description)
            rows = save(compile_table(spark, table, ids, sides=sides, test_rows=test_rows, watch=counts), f"{out}/{name}", file_format, mode)
            return record(spark, out, TableReport(name, "written", rows, stages=counts.rows() if count_stages else ()), description)
        except Exception as error:  # noqa: BLE001  any error of one table, of its description or its data
            if strict:
                raise
            log.warning("table %s failed: %s", name, error)
            return record(spark, out, TableReport(name, "failed", None, str(error).splitlines()[0][:500] if str(error) else type(error).__name__), description)

    with cleared(spark), ThreadPoolExecutor(max(1, at_once)) as pool:
        sides = shared_sides(spark, spec.tables)
        return [done, *pool.map(one, spec.tables, spec.tables.values())]


def compile_cohort(spec: PipelineSpec, tables: dict[str, DataFrame], dedupe: bool = True, rows: int | None = None, whole_subjects: bool = False) -> DataFrame:
    """Events of all tables that the description names, as one cohort (M7, M13); ``rows`` and ``whole_subjects`` are those of
    ``cohort``."""
    parts = [events(tables[name], specs, spec.subject_columns.get(name, "subject_id"), spec.separator) for name, specs in spec.events.items()]
    return cohort(*parts, dedupe=dedupe, rows=rows, whole_subjects=whole_subjects)


def event_rows(spark: SparkSession, spec: PipelineSpec) -> int:
    """About how many events a description gives: rows of the raw files (which Parquet files know), times what melting and
    unrolling make of one, times its kinds of events. What lookups lose or multiply is left out."""
    total = 0
    for name, specs in spec.events.items():
        table = spec.tables.get(name)
        each = math.prod(len(m.columns) for m in table.melt) * max(1, len(table.unroll) + table.keep_code) if table else 1
        total += read_file(spark, table.file if table else spec.patients).count() * each * len(specs)
    return total


def build_dataset(
    spark: SparkSession, spec: PipelineSpec, out: str, splits: Mapping[str, float] = SPLITS, exact: bool = False, splits_json: str | None = None, name: str = "dataset", version: str = "1.0", strict: bool = False,
    id_map: str | None = None, rows_per_file: int = FILE_ROWS, at_once: int = 1, resume: bool = False,
) -> list[TableReport]:
    """Raw files to a written dataset in one call: event tables below ``out/tables``, the cohort by split in ``out/data``,
    code metadata, subject splits and dataset metadata (JSON) below ``out/metadata``.

    Every step reads what the one before wrote. Tables that failed are left out of the cohort, as their reports say.
    ``splits_json`` names a file of split names and subject ids that go before the fractions; ``id_map`` a map of ids that
    outlives the run; ``rows_per_file`` says how many events a file of the cohort is to hold; ``at_once`` and ``resume`` are
    those of ``run_pipeline``.
    """
    reports = run_pipeline(spark, spec, f"{out}/tables", strict=strict, id_map=id_map, at_once=at_once, resume=resume)
    done = {r.table for r in reports if r.status == "written"}
    events_ = {name_: specs for name_, specs in spec.events.items() if name_ in done}
    tables = {name_: spark.read.parquet(f"{out}/tables/{name_}") for name_ in events_}
    given = read_splits(spark, splits_json) if splits_json else None
    with cleared(spark):
        split_subjects(spark.read.parquet(f"{out}/tables/subject"), splits, exact, given).write.mode("overwrite").parquet(f"{out}/metadata/subject_splits")
    by_subject = spark.read.parquet(f"{out}/metadata/subject_splits")
    rows = sum((r.rows or 0) * len(events_.get(r.table, ())) for r in reports)
    write_cohort(compile_cohort(replace(spec, events=events_), tables, rows=rows, whole_subjects=True), by_subject, f"{out}/data", rows_per_file=rows_per_file)
    whole = read_cohort(spark, f"{out}/data").drop("split", "shard")
    code_metadata(dealt_by_subject(whole, rows)).write.mode("overwrite").parquet(f"{out}/metadata/codes")
    write_metadata(dataset_metadata(whole, by_subject, name, version), f"{out}/metadata/dataset")
    return reports


def report_table(spark: SparkSession, reports: list[TableReport]) -> DataFrame:
    rows = [(r.table, r.status, r.rows, r.message) for r in reports]
    return spark.createDataFrame(rows, "table string, status string, rows bigint, message string").select(F.col("table"), "status", "rows", "message")


def stage_table(spark: SparkSession, reports: list[TableReport]) -> DataFrame:
    """(table, place, stage, rows, lost): rows of every written table after each of its stages, and how many fewer than
    after the one before; negative where a stage multiplies rows."""
    rows = []
    for r in reports:
        before = None
        for place, (stage, n) in enumerate(r.stages):
            rows.append((r.table, place, stage, n, before - n if None not in (before, n) else None))
            before = n
    return spark.createDataFrame(rows, "table string, place int, stage string, rows bigint, lost bigint")
