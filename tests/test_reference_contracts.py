"""The reference schemas' contracts against the intake traps of their data."""

from pyspark.sql import functions as F

from tabletrust.operators import checks as C
from tabletrust.plans import reference_contracts as RC
from tabletrust.session import scratch_path
from tabletrust.sources import dump as D

# Account rows as the dump delivers them, plus trap rows.
ACCOUNT_DUMP = (
    "INSERT INTO `account` VALUES\n"
    "(1,'ADMINISTRATOR','a34b',3,'','0','0','','2006-04-25 10:18:56','127.0.0.1',0,0,'0000-00-00 00:00:00',0,0,0,0),\n"
    "(2,'GAMEMASTER','7841',2,'','0','0','','2006-04-25 10:18:56','127.0.0.1',0,0,'0000-00-00 00:00:00',0,0,0,0),\n"
    "(3,'MODERATOR','a7f5',1,'','0','0','','2006-04-25 10:19:35','127.0.0.1',0,0,'0000-00-00 00:00:00',0,0,0,0),\n"
    "(4,'PLAYER','3ce8',0,'','0','0','','2006-04-25 10:19:35','127.0.0.1',0,0,'0000-00-00 00:00:00',0,0,0,0);\n"
    "INSERT INTO `account` VALUES (5,'player','x',0,NULL,NULL,NULL,NULL,'2007-01-01 00:00:00','1.2.3.4',0,0,'2007-01-02 00:00:00',0,0,0,0),"
    "(4294967296,'big','x',0,NULL,NULL,NULL,NULL,'2007-01-01 00:00:00','1.2.3.4',0,0,'2007-01-02 00:00:00',0,0,0,0),"
    "(7,'neg','x',-1,NULL,NULL,NULL,NULL,'2007-01-01 00:00:00','1.2.3.4',0,0,'2007-01-02 00:00:00',0,0,0,0),"
    "(8,'" + "n" * 33 + "','x',0,NULL,NULL,NULL,NULL,'2007-01-01 00:00:00','1.2.3.4',0,0,'2007-01-02 00:00:00',0,0,0,0),"
    "(9,NULL,'x',0,NULL,NULL,NULL,NULL,'2007-01-01 00:00:00','1.2.3.4',0,0,'2007-01-02 00:00:00',0,0,0,0);\n"
)


def test_account_intake(spark):
    path = scratch_path(spark, "account-dump")
    spark.createDataFrame([(ACCOUNT_DUMP,)], "value string").coalesce(1).write.text(path)
    good, bad = D.read_insert_dump(spark, path, "account", RC.ACCOUNT)
    rejected = {r["vals"][0]: r["reasons"] for r in bad.collect()}
    # 33 characters do not fit varchar(32)
    assert rejected == {"4294967296": ["id:out_of_range"], "7": ["gmlevel:out_of_range"], "8": ["username:too_long"]}
    g = good.drop("notes")
    assert g.where("id <= 4 AND last_login IS NULL").count() == 4  # zero dates read as NULL
    rep = {(r["rule"], r["col"]): r["n_violations"] for r in C.contract_report(g, RC.ACCOUNT).collect()}
    assert rep[("unique", "username")] == 1  # PLAYER / player under a case-insensitive collation
    assert rep[("length", "username")] == 0
    assert rep[("not_null", "username")] == 1  # explicit NULL is not replaced by the default
    assert rep[("primary_key", "id")] == 0


def test_account_defaults_fill_missing_column(spark):
    df = spark.createDataFrame([(1, "a", "h")], "id bigint, username string, sha_pass_hash string")
    out = C.apply_defaults(df, RC.ACCOUNT).first()
    assert out["last_ip"] == "0.0.0.0" and out["gmlevel"] == 0 and out["mutetime"] == 0
    assert out["joindate"] is not None and out["email"] is None


def test_realm_flags_decode(spark):
    from tabletrust.functions.scalar import decode_flags

    df = spark.createDataFrame([(2,), (0x25,), (0x82,)], "realmflags int")
    labels, unknown = decode_flags(F.col("realmflags"))
    got = [(r[0], r[1]) for r in df.select(labels, unknown).collect()]
    assert got == [(["offline"], 0), (["invalid", "show_version", "new_players"], 0), (["offline"], 0x80)]


def test_nutrient_rules(spark):
    groups = spark.createDataFrame([("0100", "Dairy")], "foodgroup_code string, foodgroup_desc string")
    foods = spark.createDataFrame(
        [("01001", "0100", "Butter, salted", "BUTTER,WITH SALT"), ("01002", "9900", "Orphan", "ORPHAN")],
        "ndb_no string, foodgroup_code string, longdesc string, shortdesc string")
    nutrients = spark.createDataFrame([("203", "g", "PROCNT", "Protein", 2, 600)],
                                      "nutr_no string, units string, tagname string, nutr_desc string, num_dec int, sr_order int")
    sources = spark.createDataFrame([("1", "Analytical")], "source_code string, description string")
    derivs = spark.createDataFrame([("A", "Analytical")], "derivation_code string, description string")
    data = spark.createDataFrame(
        [("01001", "203", 0.85, 2, 0.1, "1", None, None, 0.5, 1.0),
         ("01001", "203", 0.85, 5, 0.1, "1", "A", "01002", 1.0, 0.5),
         ("01002", "203", 0.0, 0, None, "1", None, None, None, None)],
        "ndb_no string, nutr_no string, nutrition_value double, num_data_points int, std_error double, "
        "source_code string, derivation_code string, ref_ndb_no string, min double, max double")
    good, bad = C.safe_cast(C.apply_defaults(data, RC.NUTRIENT_DATA), RC.NUTRIENT_DATA)
    assert bad.count() == 0
    assert foods.first()["ndb_no"] == "01001"  # text code keeps its leading zero
    parents = {"foods": foods, "nutrients": nutrients, "source_codes": sources, "data_derivation_codes": derivs}
    rep = {(r["rule"], r["col"]): r["n_violations"] for r in C.contract_report(good, RC.NUTRIENT_DATA, parents).collect()}
    assert rep[("primary_key", "ndb_no,nutr_no")] == 1
    assert rep[("implies", "no_error_below_3_points")] == 1
    assert rep[("ordered", "min_value_max")] == 1
    assert all(rep[k] == 0 for k in rep if k[0] == "foreign_key")  # NULL optional references pass
    frep = {(r["rule"], r["col"]): r["n_violations"]
            for r in C.contract_report(C.apply_defaults(foods, RC.FOODS), RC.FOODS, {"food_groups": groups}).collect()}
    assert frep[("foreign_key", "foodgroup_code->food_groups(foodgroup_code)")] == 1
    notes = spark.createDataFrame([("01001", "1", "X", None, "t"), ("01001", "2", "N", None, "t"), ("01001", "3", "N", "203", "t")],
                                  "ndb_no string, footnote_no string, footnote_type string, nutr_no string, footnote_text string")
    nrep = {(r["rule"], r["col"]): r["n_violations"] for r in C.contract_report(notes, RC.FOOTNOTES).collect()}
    assert nrep[("domain", "footnote_type")] == 1 and nrep[("implies", "type_n_has_nutrient")] == 1


def test_imputed_and_rounding(spark):
    from decimal import Decimal

    from tabletrust.functions.scalar import imputed, round_to

    df = spark.createDataFrame([(Decimal("0.855"), 2, 0), (Decimal("12.5"), 0, 3)], "v decimal(10,3), d int, n int")
    got = [(r[0], r[1]) for r in df.select(round_to(F.col("v"), F.col("d")), imputed(F.col("n"))).collect()]
    assert got == [(Decimal("0.860"), True), (Decimal("13.000"), False)]


def test_reference_contract_schemas_build(spark):
    for c in RC.REFERENCE_CONTRACTS.values():
        assert len(c.schema().fields) == len(c.columns)


def test_character_traps(spark):
    # UNIQUE over a nullable column: NULL keys never collide
    pet = spark.createDataFrame([(1, None, "a"), (2, None, "b"), (3, 7, "c"), (3, 7, "d")],
                                "ownerguid bigint, petitionguid bigint, name string")
    rep = {(r["rule"], r["col"]): r["n_violations"] for r in C.contract_report(pet, RC.PETITION).collect()}
    assert rep[("unique", "ownerguid,petitionguid")] == 1 and rep[("primary_key", "ownerguid")] == 1
    # a table with only a unique key, and one without any key
    gm = spark.createDataFrame([(1, 5, 0, "", ""), (2, 5, 1, "", "")], "guildid bigint, guid bigint, rank smallint, pnote string, offnote string")
    assert {r["rule"] for r in C.contract_report(gm, RC.GUILD_MEMBER).collect()} >= {"unique"}
    sv = spark.createDataFrame([(1, 0), (1, 0)], "NextMaintenanceDate bigint, cleaning_flags bigint")
    assert "primary_key" not in {r["rule"] for r in C.contract_report(sv, RC.SAVED_VARIABLES).collect()}
    # UNIX seconds in the event log read back as UTC wall-clock time
    from datetime import datetime

    from tabletrust.functions.scalar import from_epoch_seconds

    log = spark.createDataFrame([(1, 1, 1, 2, 3, 1, 1360876794)], ",".join(
        f"{c.name} bigint" for c in RC.GUILD_EVENTLOG.columns))
    assert log.select(from_epoch_seconds(F.col("TimeStamp"))).first()[0] == datetime(2013, 2, 14, 21, 19, 54)


def test_ticket_stamp_moves_only_on_change(spark):
    from datetime import datetime

    from tabletrust.operators.compare import touch_on_change

    old = spark.createDataFrame([(1, 9, "help", None, datetime(2010, 1, 1)), (2, 9, "bug", None, datetime(2010, 1, 1))],
                                "ticket_id bigint, guid bigint, ticket_text string, response_text string, ticket_lastchange timestamp")
    new = spark.createDataFrame([(1, 9, "help", None, datetime(2010, 1, 1)), (2, 9, "bug", "fixed", datetime(2010, 1, 1))],
                                old.schema)
    now = F.lit(datetime(2013, 2, 17)).cast("timestamp")
    got = {r["ticket_id"]: (r["touched"], r["ticket_lastchange"]) for r in
           touch_on_change(old, new, ["ticket_id"], RC.CHARACTER_TICKET.notes["stamp_on_change"], now=now).collect()}
    assert got == {1: (False, datetime(2010, 1, 1)), 2: (True, datetime(2013, 2, 17))}


def test_all_reference_contracts(spark):
    # 12 nutrient + 7 account + 2 poll + 47 character tables
    assert len(RC.REFERENCE_CONTRACTS) == 68
    widths = {"characters": 58, "character_pet": 23, "character_stats": 28, "character_aura": 15, "account": 17,
              "nutrient_data": 18, "foods": 14, "oscars13_nominees": 9}
    for name, n in widths.items():
        assert len(RC.REFERENCE_CONTRACTS[name].columns) == n, name
    keyless = {n for n, c in RC.REFERENCE_CONTRACTS.items() if not c.primary_key}
    assert keyless == {"footnotes", "character_honor_cp", "saved_variables", "guild_member", "character_db_version",
                       "realmd_db_version"}


def test_every_reference_contract_reports_on_empty_input(spark):
    # every contract's report plan analyses (columns, types, rule expressions
    # resolve) on a frame of its own schema; a few are also executed
    run = {"characters", "nutrient_data", "account", "character_db_version"}
    for name, c in RC.REFERENCE_CONTRACTS.items():
        empty = spark.createDataFrame([], c.schema())
        parents = {fk.parent: spark.createDataFrame([], RC.REFERENCE_CONTRACTS[fk.parent].schema())
                   for fk in c.foreign_keys}
        rep = C.contract_report(empty, c, parents)
        assert rep.columns == ["tbl", "rule", "col", "n_violations"]
        if name in run:
            assert all(r["n_violations"] == 0 for r in rep.collect()), name
