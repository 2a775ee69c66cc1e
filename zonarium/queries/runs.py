"""Queries on names, buildings and the manifest."""

from pyspark.sql import functions as F

from ..functions import lookups, names
from ..functions.scalars import WEATHER_WORDS, normalise_weather
from ..operators import manifest as m
from ..operators.ids import serial_ids
from ..operators.rows import first_by, last_by
from ..schemas import BUILDING_ATTRIBUTES, BUILDINGS, MANIFEST_COLUMNS, MANIFEST_KEY
from ..sources.tables import number_buildings
from .registry import query, table

# The 25 brand numbers stand for places: the 20 known ones, then unknown ones.
_PLACES = list(lookups.CLIMATE_ZONE_OF_LOCATION) + ["Paris", "Rome", "Oslo", "Lima", "Cairo"]
_CODES = list(lookups.LOCATION_OF_CLIMATE_ZONE) + ["CZ9", "CZ0A", "CZ", "x", "cz8", "CZ77"]


def _pick(words):
    number = F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit("")).cast("int")
    return F.get(F.array(*[F.lit(w) for w in words]), number - 1)


def _pick_sql(words):
    array = ", ".join(f"'{w}'" for w in words)
    return f"[{array}][CAST(replace(p_brand, 'Brand#', '') AS INTEGER)]"


def _case_sql(key, pairs):
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs.items())
    return f"CASE {key} {whens} ELSE 'Unknown' END"


_PLACE_SQL, _CODE_SQL = _pick_sql(_PLACES), _pick_sql(_CODES)
_ZONE_OF_SQL = _case_sql(_PLACE_SQL, lookups.CLIMATE_ZONE_OF_LOCATION)
_LOCATION_OF_SQL = _case_sql(_CODE_SQL, lookups.LOCATION_OF_CLIMATE_ZONE)


@query(f"SELECT p_partkey, {_PLACE_SQL} AS location, {_ZONE_OF_SQL} AS climate_zone FROM part")
def q_climate_zone(spark, sf_dir):
    place = _pick(_PLACES)
    return table(spark, sf_dir, "part").select(
        "p_partkey", place.alias("location"), lookups.climate_zone(place).alias("climate_zone")
    )


@query(f"SELECT p_partkey, {_CODE_SQL} AS climate_zone, {_LOCATION_OF_SQL} AS location FROM part")
def q_location(spark, sf_dir):
    code = _pick(_CODES)
    return table(spark, sf_dir, "part").select(
        "p_partkey", code.alias("climate_zone"), lookups.location(code).alias("location")
    )


# Results folders in the three naming forms, and one that fits none.
_KIND = "split_part(p_name, ' ', 2)"
_FOLDER_SQL = f"""CASE p_type
    WHEN 'ECONOMY' THEN '/r/ASHRAE_20' || p_size || '_' || {_PLACE_SQL} || '_' || {_KIND}
    WHEN 'STANDARD' THEN 'D:\\r\\IECC_20' || p_size || '_' || {_PLACE_SQL} || '_' || {_KIND}
    WHEN 'LARGE' THEN '/r/MF_' || {_CODE_SQL} || '_' || {_LOCATION_OF_SQL} || '_heat' || p_size || '_crawl_IECC_2006'
    WHEN 'MEDIUM' THEN '/r/SF_' || {_CODE_SQL} || '_' || {_LOCATION_OF_SQL} || '_heat' || p_size || '_slab_IECC_2012'
    WHEN 'SMALL' THEN '/r/MS_' || {_PLACE_SQL} || '_3B_Code' || p_size || '_gas'
    ELSE '/r/' || {_KIND} END"""


def _folder():
    kind = F.get(F.split("p_name", " "), F.lit(1))
    size = F.col("p_size").cast("string")
    place, code = _pick(_PLACES), _pick(_CODES)

    def text(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    t = F.col("p_type")
    where = lookups.location(code)
    return (
        F.when(t == "ECONOMY", text("/r/ASHRAE_20", size, "_", place, "_", kind))
        .when(t == "STANDARD", text("D:\\r\\IECC_20", size, "_", place, "_", kind))
        .when(t == "LARGE", text("/r/MF_", code, "_", where, "_heat", size, "_crawl_IECC_2006"))
        .when(t == "MEDIUM", text("/r/SF_", code, "_", where, "_heat", size, "_slab_IECC_2012"))
        .when(t == "SMALL", text("/r/MS_", place, "_3B_Code", size, "_gas"))
        .otherwise(text("/r/", kind))
    )


_HEATING_SQL = "CASE WHEN p_size > 25 THEN 'Water & Gas' END"
_ATTRIBUTES_SQL = f"""
    CASE WHEN p_type IN ('ECONOMY', 'STANDARD') THEN 'Commercial'
         WHEN p_type IN ('LARGE', 'MEDIUM') THEN 'Residential' ELSE 'Manufactured' END AS buildingcategory,
    CASE WHEN p_type IN ('ECONOMY', 'STANDARD') THEN {_KIND} ELSE 'NA' END AS buildingtype,
    CASE p_type WHEN 'ECONOMY' THEN 'ASHRAE' WHEN 'STANDARD' THEN 'IECC' WHEN 'LARGE' THEN 'IECC'
         WHEN 'MEDIUM' THEN 'IECC' WHEN 'SMALL' THEN 'Code' || p_size ELSE 'NA' END AS buildingstandard,
    CASE p_type WHEN 'ECONOMY' THEN '20' || p_size WHEN 'STANDARD' THEN '20' || p_size
         WHEN 'LARGE' THEN '2006' WHEN 'MEDIUM' THEN '2012' ELSE 'NA' END AS buildingstandardyear,
    CASE WHEN p_type IN ('ECONOMY', 'STANDARD', 'SMALL') THEN {_PLACE_SQL}
         WHEN p_type IN ('LARGE', 'MEDIUM') THEN {_LOCATION_OF_SQL} ELSE 'NA' END AS buildinglocation,
    CASE WHEN p_type IN ('ECONOMY', 'STANDARD') THEN coalesce({_HEATING_SQL}, '')
         WHEN p_type IN ('LARGE', 'MEDIUM') THEN 'heat' || p_size
         WHEN p_type = 'SMALL' THEN 'gas' ELSE 'NA' END AS buildingheatingtype,
    CASE p_type WHEN 'LARGE' THEN 'crawl' WHEN 'MEDIUM' THEN 'slab' ELSE 'NA' END AS buildingfoundationtype,
    CASE WHEN p_type IN ('ECONOMY', 'STANDARD') THEN {_ZONE_OF_SQL}
         WHEN p_type IN ('LARGE', 'MEDIUM') THEN {_CODE_SQL}
         WHEN p_type = 'SMALL' THEN '3B' ELSE 'NA' END AS buildingclimatezone,
    CASE p_type WHEN 'LARGE' THEN 'MF' WHEN 'MEDIUM' THEN 'SF' ELSE 'NA' END AS buildingprototype,
    CASE WHEN p_type = 'SMALL' THEN 'MS' WHEN p_type = 'PROMO' THEN {_KIND} ELSE 'NA' END AS buildingconfiguration"""


def _described(spark, sf_dir):
    runs = table(spark, sf_dir, "part").select(
        "p_partkey",
        _folder().alias("folder"),
        F.when(F.col("p_size") > 25, "Water & Gas").alias("heating"),
    )
    return names.with_building_attributes(runs, "folder", "heating").drop("folder", "heating")


@query(f"SELECT p_partkey, {_ATTRIBUTES_SQL} FROM part")
def q_building_names(spark, sf_dir):
    return _described(spark, sf_dir)


_ORDER = ", ".join(BUILDING_ATTRIBUTES)


@query(f"""
    WITH d AS (SELECT DISTINCT {_ORDER} FROM (SELECT {_ATTRIBUTES_SQL} FROM part)),
         o AS (SELECT row_number() OVER (ORDER BY {_ORDER}) AS buildingid, * FROM d
               WHERE buildingcategory = 'Residential')
    SELECT row_number() OVER (ORDER BY {_ORDER}) + (SELECT count(*) FROM o) AS buildingid, {_ORDER}
    FROM d WHERE buildingcategory <> 'Residential'""")
def q_add_buildings(spark, sf_dir):
    candidates = _described(spark, sf_dir).select(*BUILDING_ATTRIBUTES)
    stored = candidates.filter("buildingcategory = 'Residential'").distinct()
    stored = serial_ids(stored, "buildingid", BUILDING_ATTRIBUTES)
    return number_buildings(candidates, stored).select(*BUILDINGS.fieldNames())


@query("""
    SELECT row_number() OVER (ORDER BY c_name) + 1000 AS buildingid, c_name, c_mktsegment FROM customer""")
def q_building_ids(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_name", "c_mktsegment")
    return serial_ids(customers, "buildingid", ["c_name"], start=1000)


_MODEL_SQL = f"""CASE p_type
    WHEN 'ECONOMY' THEN '/m/ASHRAE901_' || {_KIND} || '_STD20' || p_size || '_' || {_PLACE_SQL} || '.idf'
    WHEN 'STANDARD' THEN 'C:\\m\\IECC_' || {_KIND} || '_STD20' || p_size || '_' || {_PLACE_SQL} || '.idf'
    WHEN 'LARGE' THEN '/m/US+MF+' || {_CODE_SQL} || '+gas+slab' || p_size || '+IECC_2006.idf'
    WHEN 'MEDIUM' THEN '/m/US+SF+' || {_CODE_SQL} || '+gas+heatedbsmt+IECC_2006.idf'
    WHEN 'SMALL' THEN '/m/MS_' || {_PLACE_SQL} || '_3B_Code_gas.idf'
    ELSE '/SS/officeLarge/' || {_KIND} || '_' || {_PLACE_SQL} || '_officelarge.idf' END"""


def _model():
    kind = F.get(F.split("p_name", " "), F.lit(1))
    size = F.col("p_size").cast("string")
    place, code = _pick(_PLACES), _pick(_CODES)

    def text(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    t = F.col("p_type")
    return (
        F.when(t == "ECONOMY", text("/m/ASHRAE901_", kind, "_STD20", size, "_", place, ".idf"))
        .when(t == "STANDARD", text("C:\\m\\IECC_", kind, "_STD20", size, "_", place, ".idf"))
        .when(t == "LARGE", text("/m/US+MF+", code, "+gas+slab", size, "+IECC_2006.idf"))
        .when(t == "MEDIUM", text("/m/US+SF+", code, "+gas+heatedbsmt+IECC_2006.idf"))
        .when(t == "SMALL", text("/m/MS_", place, "_3B_Code_gas.idf"))
        .otherwise(text("/SS/officeLarge/", kind, "_", place, "_officelarge.idf"))
    )


_RUN_SQL = f"""CASE p_type
    WHEN 'ECONOMY' THEN 'ASHRAE_20' || p_size || '_' || {_PLACE_SQL} || '_' || {_KIND}
    WHEN 'STANDARD' THEN 'IECC_20' || p_size || '_' || {_PLACE_SQL} || '_' || {_KIND}
    WHEN 'LARGE' THEN 'MF_' || {_CODE_SQL} || '_' || {_LOCATION_OF_SQL} || '_gas_slab' || p_size || '_IECC_2006'
    WHEN 'MEDIUM' THEN 'SF_' || {_CODE_SQL} || '_' || {_LOCATION_OF_SQL} || '_gas_heatedbsmt_IECC_2006'
    WHEN 'SMALL' THEN 'MS_' || {_PLACE_SQL} || '_3B_Code_gas'
    ELSE {_KIND} || '_' || {_PLACE_SQL} || '_officelarge' END"""


@query(f"SELECT p_partkey, {_RUN_SQL} AS run_name FROM part")
def q_run_name(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", names.run_name(_model()).alias("run_name"))


@query(f"""
    SELECT p_partkey, {_MODEL_SQL} AS "IDF Filepath" FROM part
    WHERE p_type IN ('ECONOMY', 'STANDARD', 'PROMO')""")
def q_broken_models(spark, sf_dir):
    manifest = table(spark, sf_dir, "part").select("p_partkey", _model().alias("IDF Filepath"))
    return m.drop_broken_models(manifest)


_MODEL_KIND_SQL = """CASE WHEN p_type IN ('ECONOMY', 'STANDARD') THEN 'Commercial'
    WHEN p_type IN ('LARGE', 'MEDIUM') THEN 'Residential' ELSE 'Manufactured' END"""


def _models(spark, sf_dir):
    t = F.col("p_type")
    kind = (
        F.when(t.isin("ECONOMY", "STANDARD"), "Commercial")
        .when(t.isin("LARGE", "MEDIUM"), "Residential")
        .otherwise("Manufactured")
    )
    return m.with_run(
        table(spark, sf_dir, "part").select("p_partkey", kind.alias("kind"), _model().alias("model_path"))
    )


# Weather files: one per kind and place for each nation, some with dotted names.
_DOTTED = {v: k for k, v in WEATHER_WORDS.items()}
_DOTTED_SQL = _PLACE_SQL
for _joined, _dots in _DOTTED.items():
    _DOTTED_SQL = f"replace({_DOTTED_SQL}, '{_joined}', '{_dots}')"


def _weather(spark, sf_dir):
    place = _pick(_PLACES)
    for joined, dots in _DOTTED.items():
        place = F.replace(place, F.lit(joined), F.lit(dots))
    path = F.concat(F.lit("/w/USA_"), F.get(F.split("p_name", " "), F.lit(0)), F.lit("_"), place, F.lit(".epw"))
    places = table(spark, sf_dir, "part").select(path.alias("path")).distinct()
    return places.select(
        F.explode(F.array(F.lit("Commercial"), F.lit("Residential"), F.lit("Manufactured"))).alias("kind"),
        normalise_weather(F.col("path")).alias("weather_path"),
    )


_WEATHER_SQL = f"""(
    SELECT DISTINCT '/w/USA_' || split_part(p_name, ' ', 1) || '_' || {_PLACE_SQL} || '.epw' AS weather_path
    FROM part)"""


@query(f"""
    WITH models AS (SELECT p_partkey, {_MODEL_SQL} AS model_path, {_RUN_SQL} AS run_name,
                           {_MODEL_KIND_SQL} AS kind FROM part),
         located AS (SELECT *, split_part(run_name, '_', CASE kind WHEN 'Manufactured' THEN 2 ELSE 3 END)
                            AS location FROM models)
    SELECT p_partkey, model_path, run_name, kind, location, weather_path
    FROM located JOIN {_WEATHER_SQL} ON contains(weather_path, location)""")
def q_model_weather(spark, sf_dir):
    return m.match_weather(_models(spark, sf_dir), _weather(spark, sf_dir))


@query(f"""
    WITH models AS (SELECT {_MODEL_SQL} AS model_path, {_RUN_SQL} AS run_name,
                           {_MODEL_KIND_SQL} AS kind, p_type FROM part),
         located AS (SELECT *, split_part(run_name, '_', CASE kind WHEN 'Manufactured' THEN 2 ELSE 3 END)
                            AS location FROM models)
    SELECT 'NA' AS "BuildingID", model_path AS "IDF Filepath", weather_path AS "Weather Filepath",
           '/results/' || run_name AS "Completed Simulation FolderPath", 'Not Started' AS "Simulation Status"
    FROM located JOIN {_WEATHER_SQL} ON contains(weather_path, location)
    WHERE p_type IN ('ECONOMY', 'STANDARD', 'PROMO')""")
def q_manifest_rows(spark, sf_dir):
    matched = m.match_weather(_models(spark, sf_dir), _weather(spark, sf_dir))
    return m.drop_broken_models(m.manifest_rows(matched, "/results/"))


def _manifest(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey").cast("string")
    status = F.when(F.col("o_orderstatus") == "F", "Uploaded").when(
        F.col("o_orderstatus") == "O", "Incomplete"
    ).otherwise("Not Started")
    return o.select(
        F.when(F.col("o_totalprice") > 250000, F.col("o_custkey").cast("string"))
        .otherwise("NA")
        .alias(MANIFEST_COLUMNS[0]),
        F.concat(F.lit("/m/"), key, F.lit(".idf")).alias(MANIFEST_COLUMNS[1]),
        F.col("o_orderpriority").alias(MANIFEST_COLUMNS[2]),
        F.concat(F.lit("/r/"), key).alias(MANIFEST_COLUMNS[3]),
        status.alias(MANIFEST_COLUMNS[4]),
    )


_MANIFEST_SQL = """(
    SELECT o_orderkey,
           CASE WHEN o_totalprice > 250000 THEN CAST(o_custkey AS VARCHAR) ELSE 'NA' END AS "BuildingID",
           '/m/' || o_orderkey || '.idf' AS "IDF Filepath", o_orderpriority AS "Weather Filepath",
           '/r/' || o_orderkey AS "Completed Simulation FolderPath",
           CASE o_orderstatus WHEN 'F' THEN 'Uploaded' WHEN 'O' THEN 'Incomplete' ELSE 'Not Started' END
               AS "Simulation Status"
    FROM orders)"""


@query(f"""
    SELECT m."BuildingID", m."IDF Filepath", m."Weather Filepath", m."Completed Simulation FolderPath",
           CASE WHEN l.l_orderkey IS NOT NULL THEN 'Complete' ELSE m."Simulation Status" END AS "Simulation Status"
    FROM {_MANIFEST_SQL} m LEFT JOIN
        (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_linestatus = 'F') l ON m.o_orderkey = l.l_orderkey""")
def q_manifest_update(spark, sf_dir):
    updates = (
        table(spark, sf_dir, "lineitem")
        .filter("l_linestatus = 'F'")
        .select(F.concat(F.lit("/r/"), F.col("l_orderkey").cast("string")).alias(MANIFEST_KEY))
        .distinct()
        .withColumn("value", F.lit("Complete"))
    )
    return m.update_manifest(_manifest(spark, sf_dir), updates, "Simulation Status")


@query(f"""
    SELECT "Completed Simulation FolderPath", "Simulation Status" FROM {_MANIFEST_SQL}
    WHERE "Simulation Status" <> 'Uploaded'""")
def q_pending_runs(spark, sf_dir):
    return m.pending_runs(_manifest(spark, sf_dir)).select(MANIFEST_KEY, "Simulation Status")


@query(f"""
    SELECT "Completed Simulation FolderPath", "BuildingID" FROM {_MANIFEST_SQL} WHERE "BuildingID" <> 'NA'""")
def q_has_building(spark, sf_dir):
    return m.has_building(_manifest(spark, sf_dir)).select(MANIFEST_KEY, "BuildingID")


# A folder may stand in several manifest lines: the first gives the model, the
# last one the state.
@query("""
    SELECT o_custkey, arg_min(o_orderpriority, o_orderkey) AS first_priority,
           arg_max(o_orderstatus, o_orderkey) AS last_status
    FROM orders GROUP BY o_custkey""")
def q_manifest_lookup(spark, sf_dir):
    lines = table(spark, sf_dir, "orders").select(
        "o_custkey",
        "o_orderkey",
        F.col("o_orderpriority").alias("first_priority"),
        F.col("o_orderstatus").alias("last_status"),
    )
    first = first_by(lines, ["o_custkey"], "o_orderkey", ["first_priority"])
    return first.join(last_by(lines, ["o_custkey"], "o_orderkey", ["last_status"]), "o_custkey")


def _marked(spark, sf_dir):
    """Documents as model text, with marker lines where they fit."""
    parts = [F.col("text")]
    marks = names.HEATING_MARKERS
    parts.append(F.when(F.col("source") < "src3", F.lit(f"\n{marks['Gas']}\n")).otherwise(F.lit("")))
    parts.append(F.when(F.col("lang") == "en", F.lit(f"\n{marks['Water']}\n")).otherwise(F.lit("")))
    parts.append(F.when(F.col("n_chars") > 1000, F.lit(f"{marks['Electric']} x")).otherwise(F.lit("")))
    parts.append(F.when(F.col("text").contains("the"), F.lit(marks["Steam"])).otherwise(F.lit("")))
    return table(spark, sf_dir, "documents").select("doc_id", F.concat(*parts).alias("text"))


@query("""
    SELECT doc_id, concat_ws(' & ',
        CASE WHEN contains(t, 'ALL OBJECTS IN CLASS: COIL:HEATING:WATER') THEN 'Water' END,
        CASE WHEN contains(t, 'ALL OBJECTS IN CLASS: COIL:HEATING:ELECTRIC') THEN 'Electric' END,
        CASE WHEN contains(t, 'ALL OBJECTS IN CLASS: COIL:HEATING:STEAM') THEN 'Steam' END,
        CASE WHEN contains(t, 'ALL OBJECTS IN CLASS: COIL:HEATING:GAS') THEN 'Gas' END) AS heating
    FROM (SELECT doc_id, text
        || CASE WHEN source < 'src3' THEN 'ALL OBJECTS IN CLASS: COIL:HEATING:GAS' ELSE '' END
        || CASE WHEN lang = 'en' THEN 'ALL OBJECTS IN CLASS: COIL:HEATING:WATER' ELSE '' END
        || CASE WHEN n_chars > 1000 THEN 'ALL OBJECTS IN CLASS: COIL:HEATING:ELECTRIC' ELSE '' END
        || CASE WHEN contains(text, 'the') THEN 'ALL OBJECTS IN CLASS: COIL:HEATING:STEAM' ELSE '' END AS t
        FROM documents)""")
def q_heating_tags(spark, sf_dir):
    return _marked(spark, sf_dir).select("doc_id", names.heating_tags(F.col("text")).alias("heating"))
