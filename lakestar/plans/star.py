"""The synthetic star configuration: the same refinement, star and report
steps run on the TPC-H-like test tables.

Roles: circuit = nation (country = region), driver = customer,
constructor = supplier, race = order (season = order year, the circuit is
the nation of the order's customer, the driver is that customer),
race/sprint result = latest lineitem per (order, line) with line status
F / O, status = return flag + line status.  Raw tables are built from the
source tables by the rule: every row once with ``updated_at`` 2024-01-02;
rows with key % 4 = 0 once more with ``updated_at`` 2024-01-01 and text
suffixed ``_old``; one dirty text column holding ``\\N`` where key % 7 = 0;
everything packed into one JSON string.  The silver jobs must undo all of
it.  For results the raw table is ``lineitem`` itself, which already holds
several versions per key.
"""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import NULL_SENTINEL, join_text, rename, to_day
from ..operators import (DistinctEquals, InSetOf, NotNull, attach_dimensions, join_dimension,
                         lookup_keys, union_tagged)
from ..sources import (RAW_COL, TableStore, load_or_upsert, pack_json, read, replace_table, save, scan,
                       table_exists)
from ..session import materialize, passing, warehouse_root
from .entities import EntitySpec, SharedNewest, in_parallel as _in_parallel, silver_frame, silver_job, stage_silver

# Fixed values of the raw rule.
FRESH_TS = "2024-01-02 00:00:00"
STALE_TS = "2024-01-01 00:00:00"
RACE_TIME = "12:34:56"
SEASONS = range(1995, 2002)

TS = T.TimestampNTZType()
L, I, S, D = T.LongType(), T.IntegerType(), T.StringType(), T.DoubleType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


def dirty(value: Column, key: Column) -> Column:
    """The value as text, the NULL sentinel where key % 7 = 0."""
    return F.when(key % 7 == 0, F.lit(NULL_SENTINEL)).otherwise(value.cast("string"))


def raw_with_history(df: DataFrame, key: str, fields: dict[str, Column],
                     text_fields: Sequence[str]) -> DataFrame:
    """Apply the raw rule and pack to JSON (one ``_raw`` column)."""
    fresh = df.select(*[c.alias(n) for n, c in fields.items()],
                      F.lit(FRESH_TS).cast(TS).alias("updated_at"))
    stale_fields = [(F.concat(c, F.lit("_old")) if n in text_fields else c).alias(n)
                    for n, c in fields.items()]
    stale = df.where(F.col(key) % 4 == 0).select(*stale_fields, F.lit(STALE_TS).cast(TS).alias("updated_at"))
    return pack_json(fresh.unionByName(stale))


def pack_results(li: DataFrame) -> DataFrame:
    """Raw result rows of this configuration: one JSON document per lineitem."""
    rid = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    return pack_json(li, {
        "resultid": rid, "raceid": "l_orderkey", "constructorid": "l_suppkey",
        "partkey": "l_partkey", "statusname": F.concat("l_returnflag", "l_linestatus"),
        "linestatus": "l_linestatus", "position": dirty(F.col("l_linenumber"), rid),
        "positionorder": "l_linenumber", "points": "l_quantity",
        "extendedprice": "l_extendedprice", "discount": "l_discount", "tax": "l_tax",
        "updated_at": "l_shipdate"})


def driver_fields() -> dict[str, Column]:
    k = F.col("c_custkey")
    return {"driverid": k, "driverref": F.col("c_name"), "number": dirty(F.col("c_nationkey"), k),
            "forename": F.col("c_mktsegment"), "surname": F.col("c_name")}


def _constructor_fields() -> dict[str, Column]:
    return {"constructorid": F.col("s_suppkey"), "constructorref": F.col("s_name"),
            "name": F.col("s_name"), "nationality": F.col("s_nationkey")}


def _circuit_fields() -> dict[str, Column]:
    k = F.col("n_nationkey")
    return {"circuitid": k, "name": F.col("n_name"), "country": F.col("r_name"),
            "alt": dirty(F.col("n_regionkey"), k)}


def _race_fields() -> dict[str, Column]:
    k = F.col("o_orderkey")
    return {"raceid": k, "circuitid": F.col("c_nationkey"), "driverid": F.col("o_custkey"),
            "year": F.year("o_orderdate").cast("bigint"), "date": F.to_date("o_orderdate").cast("string"),
            "time": F.when(k % 7 == 0, F.lit(NULL_SENTINEL)).otherwise(F.lit(RACE_TIME))}


def _dim_constructor(silver: DataFrame) -> DataFrame:
    return rename(silver.select("constructor_key", "constructor_ref", "name", "nationality", "updated_at"),
                  {"name": "constructor_name", "nationality": "constructor_nationality"})


def _dim_driver(silver: DataFrame) -> DataFrame:
    d = silver.withColumn("driver_fullname", join_text("forename", "surname"))
    return rename(d.select("driver_key", "driver_ref", "number", "forename", "surname",
                           "driver_fullname", "updated_at"),
                  {"number": "driver_number", "forename": "driver_forename", "surname": "driver_surname"})


def _fingerprint(spark: SparkSession, folder: str) -> tuple:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return ()
    out, files = [], fs.listFiles(path, True)       # a table may be a folder of files
    while files.hasNext():
        st = files.next()
        out.append((st.getPath().toString(), st.getLen(), st.getModificationTime()))
    return tuple(sorted(out))


# ---- entity specs -------------------------------------------------------

CIRCUIT = EntitySpec(
    name="silver_circuit",
    raw_schema=_schema(("circuitid", I), ("name", S), ("country", S), ("alt", S), ("updated_at", TS)),
    natural_key=["circuitid"], key_col="circuit_key",
    sentinel_cols=["alt"], casts={"alt": "int"},
    renames={"circuitid": "circuit_id", "name": "circuit_name", "country": "circuit_country",
             "alt": "circuit_alt"},
    columns=["circuit_id", "circuit_name", "circuit_country", "circuit_alt", "updated_at"],
    rules=[NotNull("circuitid")],
)

DRIVER = EntitySpec(
    name="silver_driver",
    raw_schema=_schema(("driverid", L), ("driverref", S), ("number", S), ("forename", S),
                       ("surname", S), ("updated_at", TS)),
    natural_key=["driverid"], key_col="driver_key",
    sentinel_cols=["number"], casts={"number": "int"},
    renames={"driverid": "driver_id", "driverref": "driver_ref"},
    columns=["driver_id", "driver_ref", "number", "forename", "surname", "updated_at"],
    rules=[NotNull("driverid")],
)

CONSTRUCTOR = EntitySpec(
    name="silver_constructor",
    raw_schema=_schema(("constructorid", L), ("constructorref", S), ("name", S),
                       ("nationality", I), ("updated_at", TS)),
    natural_key=["constructorid"], key_col="constructor_key",
    renames={"constructorid": "constructor_id", "constructorref": "constructor_ref"},
    columns=["constructor_id", "constructor_ref", "name", "nationality", "updated_at"],
    rules=[NotNull("constructorid")],
)

RACE = EntitySpec(
    name="silver_race",
    raw_schema=_schema(("raceid", L), ("circuitid", I), ("driverid", L), ("year", L),
                       ("date", S), ("time", S), ("updated_at", TS)),
    natural_key=["raceid"], key_col="race_key",
    sentinel_cols=["time"], datetimes={"datetime": ("date", "time")},
    renames={"raceid": "race_id", "circuitid": "circuit_id", "driverid": "driver_id",
             "year": "race_year", "datetime": "race_datetime"},
    columns=["race_id", "circuit_id", "driver_id", "race_year", "race_datetime", "updated_at"],
    rules=[NotNull("raceid"), NotNull("circuitid"), DistinctEquals("year", SEASONS)],
)

_RESULT_SCHEMA = _schema(
    ("resultid", L), ("raceid", L), ("constructorid", L), ("partkey", L), ("statusname", S),
    ("linestatus", S), ("position", S), ("positionorder", I), ("points", D),
    ("extendedprice", D), ("discount", D), ("tax", D), ("updated_at", TS))


def _result_spec(name: str, key_col: str, line_status: str) -> EntitySpec:
    return EntitySpec(
        name=name, raw_schema=_RESULT_SCHEMA, natural_key=["resultid"], key_col=key_col,
        tiebreak=["partkey", "constructorid", "extendedprice", "points", "discount", "tax"],
        # deduplicate first, split by line status after
        split=("linestatus", line_status), versions="silver_result__versions",
        sentinel_cols=["position"], casts={"position": "int"},
        renames={"resultid": "result_id", "raceid": "race_id", "constructorid": "constructor_id",
                 "statusname": "status_name", "positionorder": "position_order"},
        columns=["result_id", "race_id", "constructor_id", "status_name", "position",
                 "position_order", "points", "updated_at"],
        rules=[NotNull("resultid"), NotNull("raceid"), NotNull("constructorid")],
    )


RACE_RESULT = _result_spec("silver_race_result", "race_result_key", "F")
SPRINT_RESULT = _result_spec("silver_sprint_result", "sprint_result_key", "O")

STATUS = EntitySpec(
    name="silver_status",
    raw_schema=_schema(("statusname", S), ("updated_at", TS)),
    natural_key=["statusname"], key_col="status_key",
    renames={"statusname": "status_name"},
    columns=["status_name", "updated_at"],
    rules=[NotNull("statusname")],
)


class _Frame:
    """A lazily built frame of a pipeline.  Once its layer is published it is
    read from the registry on every access, so no answer or refresh ever works
    on a frame of an earlier state."""

    def __init__(self, build):
        self.build, self.name, self.__doc__ = build, build.__name__, build.__doc__
        prefix = "" if self.name.startswith("silver_") else "gold_"
        self.table = "gold_report_result" if self.name == "report" else prefix + self.name

    def __get__(self, pipeline, owner=None):
        if pipeline is None:
            return self
        if self.name in pipeline.live:
            return read(pipeline.spark, self.table)
        if self.name not in pipeline.frames:
            pipeline.frames[self.name] = self.build(pipeline)
        return pipeline.frames[self.name]


class StarPipeline:
    """Lazily built frames of the whole synthetic pipeline for one data
    folder.  Every frame is derived from the given tables by Spark."""

    _shared: dict[tuple, "StarPipeline"] = {}

    def __init__(self, spark: SparkSession, sf_dir: str, run_gates: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.run_gates = run_gates
        self.frames: dict[str, DataFrame] = {}      # of layers not published yet
        self.newest_results = SharedNewest()        # of both result frames
        self.live: set[str] = set()                 # published layers

    @classmethod
    def shared(cls, spark: SparkSession, sf_dir: str) -> "StarPipeline":
        """One pipeline per (application, data folder, folder contents):
        queries of a session share the silver layer computed (and
        checkpointed) once, as a dashboard shares the refreshed tables.  A
        change of any source file (size or modification time) starts over."""
        key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), _fingerprint(spark, sf_dir))
        if key not in cls._shared:
            for old in [k for k in cls._shared if k[:2] == key[:2]]:
                del cls._shared[old]                # the folder's earlier contents
            cls._shared[key] = cls(spark, sf_dir)
        return cls._shared[key]

    def table(self, name: str) -> DataFrame:
        return scan(self.spark, f"{self.sf_dir}/{name}.parquet")

    # ---- raw (bronze) tables ------------------------------------------
    @_Frame
    def raw_circuit(self) -> DataFrame:
        return raw_with_history(self._circuit_source(self.table("nation")), "n_nationkey",
                                _circuit_fields(), ["name", "country", "alt"])

    def _circuit_source(self, nation: DataFrame) -> DataFrame:
        return nation.join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))

    def _race_source(self, orders: DataFrame) -> DataFrame:
        return orders.join(self.table("customer").select("c_custkey", "c_nationkey"),
                           F.col("o_custkey") == F.col("c_custkey"))

    @_Frame
    def raw_driver(self) -> DataFrame:
        return raw_with_history(self.table("customer"), "c_custkey", driver_fields(),
                                ["driverref", "number", "forename", "surname"])

    @_Frame
    def raw_constructor(self) -> DataFrame:
        return raw_with_history(self.table("supplier"), "s_suppkey", _constructor_fields(),
                                ["constructorref", "name"])

    @_Frame
    def raw_race(self) -> DataFrame:
        return raw_with_history(self._race_source(self.table("orders")), "o_orderkey", _race_fields(),
                                ["date", "time"])

    @_Frame
    def raw_result(self) -> DataFrame:
        return pack_results(self.table("lineitem"))

    @_Frame
    def raw_status(self) -> DataFrame:
        return pack_json(self.table("lineitem"), {
            "statusname": F.concat("l_returnflag", "l_linestatus"), "updated_at": "l_shipdate"})

    # ---- silver ---------------------------------------------------------
    def _silver(self, raw: DataFrame, spec: EntitySpec, extra=(), shared: SharedNewest | None = None) -> DataFrame:
        return silver_frame(raw, spec, run_gate=self.run_gates, extra_rules=extra, shared=shared)

    @_Frame
    def silver_circuit(self) -> DataFrame:
        return self._silver(self.raw_circuit, CIRCUIT)

    @_Frame
    def silver_driver(self) -> DataFrame:
        return self._silver(self.raw_driver, DRIVER)

    @_Frame
    def silver_constructor(self) -> DataFrame:
        return self._silver(self.raw_constructor, CONSTRUCTOR)

    @_Frame
    def silver_race(self) -> DataFrame:
        return self._silver(self.raw_race, RACE)

    def _status_rule(self) -> list:
        # every result's status must be a known status (a key of the status table)
        return [InSetOf("statusname", self.silver_status, "status_name")]

    @_Frame
    def silver_race_result(self) -> DataFrame:
        return self._silver(self.raw_result, RACE_RESULT, self._status_rule(), self.newest_results)

    @_Frame
    def silver_sprint_result(self) -> DataFrame:
        return self._silver(self.raw_result, SPRINT_RESULT, self._status_rule(), self.newest_results)

    @_Frame
    def silver_status(self) -> DataFrame:
        return self._silver(self.raw_status, STATUS)

    # ---- gold dimensions -------------------------------------------------
    @_Frame
    def dim_constructor(self) -> DataFrame:
        return _dim_constructor(self.silver_constructor)

    @_Frame
    def dim_driver(self) -> DataFrame:
        return _dim_driver(self.silver_driver)

    @_Frame
    def dim_race(self) -> DataFrame:
        return self._dim_race(self.silver_race)

    def _dim_race(self, races: DataFrame) -> DataFrame:
        r = join_dimension(races.drop("updated_at"), self.silver_circuit, "circuit_id",
                           ["circuit_name", "circuit_country", "circuit_alt"], how="inner")
        return r.withColumn("race_date", to_day("race_datetime")) \
                .select("race_key", "circuit_name", "circuit_country", "circuit_alt", "race_year",
                        "race_date", "race_datetime", "driver_id")

    @_Frame
    def dim_status(self) -> DataFrame:
        return self.silver_status.select("status_key", "status_name", "updated_at")

    def dim_circuit(self) -> DataFrame:
        """P5: the registered but never built circuit dimension, a plain
        projection of silver."""
        return self.silver_circuit.select("circuit_key", "circuit_id", "circuit_name", "circuit_country",
                                          "circuit_alt")

    # ---- gold facts ------------------------------------------------------
    def _fact(self, results: DataFrame, whole: bool = False) -> DataFrame:
        """The race gives its surrogate key and, in this configuration, the
        driver.  For the whole fact, the driver's key is looked up once per race
        and not once per result, of which there are several times as many; for a
        batch of results, only their races' drivers are looked up."""
        f = results.select("result_id", "race_id", "constructor_id", "status_name",
                           "position_order", "points")
        races = self.silver_race.select("race_id", "race_key", "driver_id")
        if whole:
            races = lookup_keys(races, self.silver_driver, "driver_id", "driver_id", "driver_key")
            f = join_dimension(f, races, "race_id", ["race_key", "driver_key"], how="inner").drop("race_id")
        else:
            f = join_dimension(f, races, "race_id", ["race_key", "driver_id"], how="inner").drop("race_id")
            f = lookup_keys(f, self.silver_driver, "driver_id", "driver_id", "driver_key")
        f = lookup_keys(f, self.silver_constructor, "constructor_id", "constructor_id", "constructor_key")
        f = lookup_keys(f, self.silver_status, "status_name", "status_name", "status_key")
        return f.select("result_id", "race_key", "driver_key", "constructor_key", "status_key",
                        "position_order", "points")

    @_Frame
    def fct_race_result(self) -> DataFrame:
        return self._fact(self.silver_race_result, whole=True)

    @_Frame
    def fct_sprint_result(self) -> DataFrame:
        return self._fact(self.silver_sprint_result, whole=True)

    # ---- report ----------------------------------------------------------
    @_Frame
    def report(self) -> DataFrame:
        return self._report(self.fct_race_result, self.fct_sprint_result)

    def _report(self, fct_race: DataFrame, fct_sprint: DataFrame) -> DataFrame:
        facts = union_tagged({"full_race": fct_race, "sprint": fct_sprint},
                             "race_type", renames={"full_race": {"result_id": "result_key"},
                                                   "sprint": {"result_id": "result_key"}})
        rep = attach_dimensions(facts, [
            (self.dim_race, "race_key", ["race_year", "race_date", "circuit_name", "circuit_country"], None),
            # the report names a driver by the source name (driver_ref) here
            (self.dim_driver, "driver_key", {"driver_ref": "driver_fullname"}, None),
            (self.dim_constructor, "constructor_key", ["constructor_name"], None),
            (self.dim_status, "status_key", ["status_name"], None),
        ])
        return rep.select("result_key", "race_type", "race_year", "race_date", "circuit_name",
                          "circuit_country", "driver_fullname", "constructor_name", "status_name",
                          "position_order", "points")

    # ---- C15: the whole run, publishing every layer --------------------------
    # status first: the result jobs check their statuses against it
    SILVER = {"status": STATUS, "circuit": CIRCUIT, "driver": DRIVER, "constructor": CONSTRUCTOR,
              "race": RACE, "race_result": RACE_RESULT, "sprint_result": SPRINT_RESULT}
    GOLD_KEYS = {"dim_constructor": ["constructor_key"], "dim_driver": ["driver_key"],
                 "dim_race": ["race_key"], "dim_status": ["status_key"],
                 "fct_race_result": ["result_id"], "fct_sprint_result": ["result_id"]}

    def publish(self, timer=None, num_buckets: int | None = None, parallel: int = 4) -> dict[str, DataFrame]:
        """Sync raw tables, refresh silver (upsert with keys), rebuild gold
        and the report, each layer written as a published table and read
        back by the next one.  Raw rows are stamped with ``_ingested_at`` and
        silver tables are stored in key buckets, so a later refresh reads
        only new raw rows and rewrites only touched buckets.

        Independent jobs of a layer are submitted from ``parallel`` driver
        threads, so small tables do not leave the cluster idle while one job
        waits on a single task (dependencies: status before the results,
        silver before gold, gold before the report).  ``timer(stage)`` is a
        context manager used to time the stages."""
        with passing(self.spark):
            return self._publish(timer, num_buckets, parallel)

    def _publish(self, timer, num_buckets: int | None, parallel: int) -> dict[str, DataFrame]:
        import contextlib
        timer = timer or (lambda _stage: contextlib.nullcontext())
        out: dict[str, DataFrame] = {}
        warehouse_root(self.spark)  # resolve shared settings before threads start

        def bronze_of(entity: str) -> str:
            return "bronze_result" if entity.endswith("_result") else f"bronze_{entity}"

        def sync(name: str) -> DataFrame:
            src = self.raw_result if name == "bronze_result" else getattr(self, name.replace("bronze_", "raw_"))
            if table_exists(self.spark, name):      # raw rows that are there already are not synced again
                src = materialize(src.join(read(self.spark, name).select(RAW_COL), RAW_COL, "left_anti"), "unseen")
                if src.isEmpty():
                    return read(self.spark, name)
            save(src.withColumn("_ingested_at", F.current_timestamp()), name, mode="append")
            return read(self.spark, name)

        results = SharedNewest()

        def stage(entity: str):
            of_results = entity.endswith("_result")
            extra = [InSetOf("statusname", out["silver_status"], "status_name")] \
                if of_results else []
            return stage_silver(out[bronze_of(entity)], self.SILVER[entity], run_gate=self.run_gates,
                                extra_rules=extra, incremental=True, num_buckets=num_buckets,
                                shared=results if of_results else None)

        with timer("sync_bronze"):
            names = list(dict.fromkeys(bronze_of(e) for e in self.SILVER))
            out.update(_in_parallel({n: (lambda n=n: sync(n)) for n in names}, parallel))
        with timer("silver"), passing(self.spark):
            # known statuses = the refreshed status table (same keys as its raw rows)
            out["silver_status"] = stage("status")()
            rest = [e for e in self.SILVER if e != "status"]
            # nothing is published before all gates of the layer passed
            staged = _in_parallel({e: (lambda e=e: stage(e)) for e in rest}, parallel)
            done = _in_parallel(staged, parallel)
            out.update({f"silver_{e}": t for e, t in done.items()})
            self.live |= {f"silver_{e}" for e in self.SILVER}
        with timer("gold"):
            def gold(name: str) -> DataFrame:
                # a full rebuild replaces; tables are bucketed like silver so that
                # a refresh rewrites only the buckets of its keys
                source = name.replace("dim_", "silver_").replace("fct_", "silver_")
                return replace_table(type(self).__dict__[name].build(self), f"gold_{name}", self.GOLD_KEYS[name],
                                     num_buckets, expected_bytes=TableStore(self.spark, source).size(),
                                     sort=name.startswith("dim_"))
            done = _in_parallel({n: (lambda n=n: gold(n)) for n in self.GOLD_KEYS}, parallel)
            self.live |= set(self.GOLD_KEYS)
            out.update({f"gold_{name}": table for name, table in done.items()})
        with timer("report"):
            rows = self._report(self.fct_race_result, self.fct_sprint_result)
            facts = sum(TableStore(self.spark, f"gold_{f}").size() for f in self.GOLD_KEYS if f.startswith("fct_"))
            out["gold_report_result"] = replace_table(rows, "gold_report_result", ["result_key", "race_type"],
                                                      num_buckets, expected_bytes=facts)
            self.live.add("report")
        self.frames.clear()
        return out

    def refresh_results(self, changed_lineitems: DataFrame, num_buckets: int | None = None) -> dict:
        """An incremental refresh of both result tables after :meth:`publish`:
        new versions of some lineitems land in the raw table (stamped with
        the ingestion time); each silver job then reads only those rows and
        rewrites only the key buckets they touch."""
        with passing(self.spark):
            return self._refresh_results(changed_lineitems, num_buckets)

    def _refresh_results(self, changed_lineitems: DataFrame, num_buckets: int | None) -> dict:
        from ..sources import flatten_json
        save(pack_results(changed_lineitems).withColumn("_ingested_at", F.current_timestamp()),
             "bronze_result", mode="append")
        raw = read(self.spark, "bronze_result")
        # the result ids of this batch (read before the silver cursor moves on)
        cursor = TableStore(self.spark, "silver_race_result").cursor()
        new_raw = raw if cursor is None else raw.where(F.col("_ingested_at") > F.timestamp_micros(F.lit(cursor)))
        touched = materialize(flatten_json(new_raw, _RESULT_SCHEMA).select(F.col("resultid").alias("result_id"))
                              .distinct(), "touched")
        statuses = read(self.spark, "silver_status")
        results = SharedNewest()
        out = _in_parallel({entity: (lambda entity=entity: silver_job(
            raw, self.SILVER[entity], run_gate=self.run_gates, incremental=True, num_buckets=num_buckets,
            shared=results, extra_rules=[InSetOf("statusname", statuses, "status_name")]))
            for entity in ("race_result", "sprint_result")}, 2)
        # gold facts of the touched results only (a result that moved to the
        # other table is deleted from this one), then their report rows
        pairs = (("race_result", "fct_race_result"), ("sprint_result", "fct_sprint_result"))
        facts = {fact: materialize(self._fact(out[entity].join(touched, "result_id", "left_semi")), fact)
                 for entity, fact in pairs}
        out.update(_in_parallel({fact: (lambda fact=fact: load_or_upsert(
            facts[fact], f"gold_{fact}", ["result_id"], delete_keys=touched)) for _, fact in pairs}, 2))
        rows = materialize(self._report(facts["fct_race_result"], facts["fct_sprint_result"]), "report-rows")
        gone = touched.select(F.col("result_id").alias("result_key"),
                              F.explode(F.array(F.lit("full_race"), F.lit("sprint"))).alias("race_type"))
        out["report_result"] = load_or_upsert(rows, "gold_report_result", ["result_key", "race_type"],
                                              delete_keys=gone)
        return out

    def refresh_dimension(self, entity: str, changed_rows: DataFrame, num_buckets: int | None = None) -> dict:
        """Carry changed source rows of a dimension through silver, the gold
        dimension and every report row that shows them (attribute changes;
        ``changed_rows`` has the columns of the entity's source table):

        * ``driver`` / ``constructor``: the dimension rows of the touched
          keys, the facts that refer to them (members that arrive after their
          results bring these back), then the report rows of their facts;
        * ``race``: the race dimension rows, the facts of those races (a
          result's driver comes through its race here), their report rows;
        * ``circuit``: the race dimension rows of races at those circuits,
          then their report rows.

        Only facts of touched keys are re-joined; the report is upserted on
        (result_key, race_type)."""
        with passing(self.spark):
            return self._refresh_dimension(entity, changed_rows, num_buckets)

    def _refresh_dimension(self, entity: str, changed_rows: DataFrame, num_buckets: int | None) -> dict:
        from ..sources import flatten_json
        spec = self.SILVER[entity]
        sources = {"driver": (lambda d: d, driver_fields, "bronze_driver"),
                   "constructor": (lambda d: d, _constructor_fields, "bronze_constructor"),
                   "race": (self._race_source, _race_fields, "bronze_race"),
                   "circuit": (self._circuit_source, _circuit_fields, "bronze_circuit")}
        prepare_src, fields, bronze = sources[entity]
        src = prepare_src(changed_rows)
        raw = pack_json(src.select(*[c.alias(n) for n, c in fields().items()],
                                   F.current_timestamp().cast(TS).alias("updated_at")))
        save(raw.withColumn("_ingested_at", F.current_timestamp()), bronze, mode="append")
        all_raw = read(self.spark, bronze)
        cursor = TableStore(self.spark, spec.name).cursor()
        new_raw = all_raw if cursor is None else \
            all_raw.where(F.col("_ingested_at") > F.timestamp_micros(F.lit(cursor)))
        natural = spec.key_order[0]
        touched_ids = materialize(flatten_json(new_raw, spec.raw_schema)
                                  .select(F.col(spec.natural_key[0]).alias(natural)).distinct(), "touched")
        out = {"silver": silver_job(all_raw, spec, run_gate=self.run_gates, incremental=True,
                                    num_buckets=num_buckets)}
        changed_silver = materialize(out["silver"].join(touched_ids, natural, "left_semi"), "changed")

        race_ids = constructors = None          # whose facts are built anew
        if entity in ("driver", "constructor"):
            build, dim_name, key_col = {"driver": (_dim_driver, "dim_driver", "driver_key"),
                                        "constructor": (_dim_constructor, "dim_constructor",
                                                        "constructor_key")}[entity]
            out["dim"] = load_or_upsert(build(changed_silver), f"gold_{dim_name}", [key_col])
            keys = changed_silver.select(key_col).distinct()
            if entity == "driver":
                race_ids = materialize(self.silver_race.join(touched_ids, "driver_id", "left_semi").select("race_id"), "races")
            else:
                constructors = touched_ids
        else:
            races = changed_silver if entity == "race" else \
                self.silver_race.join(touched_ids, "circuit_id", "left_semi")
            out["dim"] = load_or_upsert(self._dim_race(races), "gold_dim_race", ["race_key"])
            key_col = "race_key"
            keys = materialize(races.select(key_col).distinct(), "touched")
            if entity == "race":
                race_ids = changed_silver.select("race_id")
        if race_ids is not None or constructors is not None:
            on, ids = ("race_id", race_ids) if race_ids is not None else ("constructor_id", constructors)
            for res, fact in (("race_result", "fct_race_result"), ("sprint_result", "fct_sprint_result")):
                results = getattr(self, f"silver_{res}").join(ids, on, "left_semi")
                out[fact] = load_or_upsert(materialize(self._fact(results), fact), f"gold_{fact}", ["result_id"])
        fr = self.fct_race_result.join(keys, key_col, "left_semi")
        fs = self.fct_sprint_result.join(keys, key_col, "left_semi")
        out["report"] = load_or_upsert(materialize(self._report(fr, fs), "report-rows"), "gold_report_result",
                                       ["result_key", "race_type"])
        return out

    # ---- the six questions over this configuration's report -----------------
    def questions(self, incident_statuses=("RF", "RO"), top: int = 3) -> dict[str, DataFrame]:
        """Q1-Q6 over the report (and the race dimension for race counts)."""
        from ..operators import (champions, count_distinct_by, incident_counts, season_totals,
                                 standings, top_k)
        win = (F.col("position_order") == 1) & (F.col("race_type") == "full_race")
        drivers = season_totals(self.report, "race_year", "driver_fullname", "points", win)
        teams = season_totals(self.report, "race_year", "constructor_name", "points", win)
        races = count_distinct_by(self.dim_race, "circuit_country", "race_key", "races")
        return {
            "champion_driver": champions(drivers), "champion_constructor": champions(teams),
            "driver_standings": standings(drivers), "constructor_standings": standings(teams),
            "races_per_country": races,
            "top_countries": top_k(races, [F.col("races").desc(), F.col("circuit_country").asc()], top),
            "dangerous_circuits": incident_counts(self.report, "circuit_name", "status_name",
                                                  list(incident_statuses), with_rate=True),
        }
