"""Contracts of the reference's own schemas: the food-nutrient database
(12 tables), the account database (7), the two-snapshot poll database
(2; both snapshots share the declaration) and the character database
(47): 68 distinct contracts.  Several character tables carry traps (no
key, a unique key over a nullable column, an on-update stamp, generated
keys, UNIX-time columns, flag masks declared ``tinyint(1)``).

Fixed values (from the declarations): code widths 4 (food group), 5
(food number), 3 (nutrient), 2 (source code) digits kept as text;
documented description lengths 200 and 60; footnote types D, M, N; the
unsigned maxima of tinyint (255), smallint (65535), int (4294967295)
and bigint (18446744073709551615); the MySQL defaults below.
"""

from __future__ import annotations

from tabletrust.contract import CURRENT_TIMESTAMP, Col, ForeignKey, Implies, Ordered, TableContract, unsigned

NUM = "decimal(38,12)"  # ``numeric`` without precision

# ------------------------------------------------------------------ food-nutrient schema
FOOD_GROUPS = TableContract(
    "food_groups",
    (Col("foodgroup_code", "string", False, max_length=4), Col("foodgroup_desc", "string", False)),
    primary_key=("foodgroup_code",),
)
FOODS = TableContract(
    "foods",
    (
        Col("ndb_no", "string", False, max_length=5),
        Col("foodgroup_code", "string", False, max_length=4),
        Col("longdesc", "string", False, max_length=200),
        Col("shortdesc", "string", False, max_length=60),
        Col("common_name", "string"),
        Col("manufacturer_name", "string"),
        Col("survey", "string"),
        Col("refuse_description", "string"),
        Col("refuse", NUM, lo=0, hi=100),
        Col("scientific_name", "string"),
        Col("n_factor", NUM),
        Col("pro_factor", NUM),
        Col("fat_factor", NUM),
        Col("cho_factor", NUM),
    ),
    primary_key=("ndb_no",),
    foreign_keys=(ForeignKey(("foodgroup_code",), "food_groups", ("foodgroup_code",)),),
)
LANGUAL_DESC = TableContract(
    "langua_l_desc",
    (Col("factor_code", "string", False), Col("description", "string", False)),
    primary_key=("factor_code",),
)
LANGUAL_FACTORS = TableContract(
    "langua_l_factors",
    (Col("ndb_no", "string", max_length=5), Col("factor_code", "string")),
    primary_key=("ndb_no", "factor_code"),
    foreign_keys=(
        ForeignKey(("ndb_no",), "foods", ("ndb_no",)),
        ForeignKey(("factor_code",), "langua_l_desc", ("factor_code",)),
    ),
)
NUTRIENTS = TableContract(
    "nutrients",
    (
        Col("nutr_no", "string", False, max_length=3),
        Col("units", "string", False),
        Col("tagname", "string"),
        Col("nutr_desc", "string", False),
        Col("num_dec", "int", False, lo=0),
        Col("sr_order", NUM, False),
    ),
    primary_key=("nutr_no",),
)
SOURCE_CODES = TableContract(
    "source_codes",
    (Col("source_code", "string", False, max_length=2), Col("description", "string", False)),
    primary_key=("source_code",),
)
DERIVATION_CODES = TableContract(
    "data_derivation_codes",
    (Col("derivation_code", "string", False), Col("description", "string", False)),
    primary_key=("derivation_code",),
)
WEIGHTS = TableContract(
    "weights",
    (
        Col("ndb_no", "string", max_length=5),
        Col("seq", "string"),
        Col("amount", NUM, False),
        Col("msre_desc", "string", False),
        Col("gram_weight", NUM, False),
        Col("num_data_points", NUM),
        Col("std_dev", NUM),
    ),
    primary_key=("ndb_no", "seq"),
    foreign_keys=(ForeignKey(("ndb_no",), "foods", ("ndb_no",)),),
)
FOOTNOTES = TableContract(
    "footnotes",
    (
        Col("ndb_no", "string", max_length=5),
        Col("footnote_no", "string"),
        Col("footnote_type", "string", domain=("D", "M", "N")),
        Col("nutr_no", "string", max_length=3),
        Col("footnote_text", "string", False),
    ),
    # No primary key by design: one footnote number may cover several nutrients.
    foreign_keys=(
        ForeignKey(("ndb_no",), "foods", ("ndb_no",)),
        ForeignKey(("nutr_no",), "nutrients", ("nutr_no",)),
    ),
    implies=(Implies("type_n_has_nutrient", "footnote_type = 'N'", "nutr_no IS NOT NULL"),),
)
SOURCES_OF_DATA = TableContract(
    "sources_of_data",
    (
        Col("datasource_id", "string", False),
        Col("authors", "string"),
        Col("title", "string", False),
        Col("year", "string"),
        Col("journal", "string"),
        Col("vol_city", "string"),
        Col("issue_state", "string"),
        Col("start_page", "string"),
        Col("end_page", "string"),
    ),
    primary_key=("datasource_id",),
)
SOURCES_ASSOC = TableContract(
    "sources_of_data_assoc",
    (Col("ndb_no", "string", max_length=5), Col("nutr_no", "string", max_length=3), Col("datasource_id", "string")),
    primary_key=("ndb_no", "nutr_no", "datasource_id"),
    foreign_keys=(
        ForeignKey(("ndb_no",), "foods", ("ndb_no",)),
        ForeignKey(("nutr_no",), "nutrients", ("nutr_no",)),
        ForeignKey(("datasource_id",), "sources_of_data", ("datasource_id",)),
    ),
)
NUTRIENT_DATA = TableContract(
    "nutrient_data",
    (
        Col("ndb_no", "string", max_length=5),
        Col("nutr_no", "string", max_length=3),
        Col("nutrition_value", NUM, False),
        Col("num_data_points", NUM, False, lo=0),
        Col("std_error", NUM),
        Col("source_code", "string", False),
        Col("derivation_code", "string"),
        Col("ref_ndb_no", "string", max_length=5),
        Col("add_nutr_mark", "string"),
        Col("num_studies", NUM),
        Col("min", NUM),
        Col("max", NUM),
        Col("degrees_freedom", NUM),
        Col("low_error_bound", NUM),
        Col("upper_error_bound", NUM),
        Col("stat_comments", "string"),
        Col("add_mod_date", "string"),
        Col("confidence_code", "string"),
    ),
    primary_key=("ndb_no", "nutr_no"),
    foreign_keys=(
        ForeignKey(("ndb_no",), "foods", ("ndb_no",)),
        ForeignKey(("nutr_no",), "nutrients", ("nutr_no",)),
        ForeignKey(("source_code",), "source_codes", ("source_code",)),
        ForeignKey(("derivation_code",), "data_derivation_codes", ("derivation_code",)),
        ForeignKey(("ref_ndb_no",), "foods", ("ndb_no",)),
    ),
    implies=(Implies("no_error_below_3_points", "num_data_points < 3", "std_error IS NULL"),),
    ordered=(
        Ordered("min_value_max", "min", "nutrition_value", "max"),
        Ordered("error_bounds", "low_error_bound", "nutrition_value", "upper_error_bound"),
    ),
)

NUTRIENT_SCHEMA = {
    c.name: c
    for c in (
        FOOD_GROUPS, FOODS, LANGUAL_DESC, LANGUAL_FACTORS, NUTRIENTS, SOURCE_CODES, DERIVATION_CODES,
        WEIGHTS, FOOTNOTES, SOURCES_OF_DATA, SOURCES_ASSOC, NUTRIENT_DATA,
    )
}

# ------------------------------------------------------------------ account schema
def _d(value):
    return {"default": value, "has_default": True}


REALMD_DB_VERSION = TableContract("realmd_db_version", (Col("required_z2426_01_realmd_relations", "boolean"),))
ACCOUNT = TableContract(
    "account",
    (
        unsigned("id", 32, nullable=False),
        Col("username", "string", False, max_length=32, ci=True, **_d("")),
        Col("sha_pass_hash", "string", False, max_length=40, **_d("")),
        unsigned("gmlevel", 8, nullable=False, **_d(0)),
        Col("sessionkey", "string"),
        Col("v", "string"),
        Col("s", "string"),
        Col("email", "string"),
        Col("joindate", "timestamp", False, **_d(CURRENT_TIMESTAMP)),
        Col("last_ip", "string", False, max_length=30, **_d("0.0.0.0")),
        unsigned("failed_logins", 32, nullable=False, **_d(0)),
        unsigned("locked", 8, nullable=False, **_d(0)),
        # declared NOT NULL with the zero date as default; the zero date reads as NULL
        Col("last_login", "timestamp"),
        unsigned("active_realm_id", 32, nullable=False, **_d(0)),
        unsigned("expansion", 8, nullable=False, **_d(0)),
        unsigned("mutetime", 64, nullable=False, **_d(0)),
        unsigned("locale", 8, nullable=False, **_d(0)),
    ),
    primary_key=("id",),
    unique=(("username",),),
    generated_key="id",
)
ACCOUNT_BANNED = TableContract(
    "account_banned",
    (
        unsigned("id", 32, nullable=False),
        Col("bandate", "bigint", False, **_d(0)),
        Col("unbandate", "bigint", False, **_d(0)),
        Col("bannedby", "string", False, max_length=50),
        Col("banreason", "string", False, max_length=255),
        Col("active", "tinyint", False, **_d(1)),
    ),
    primary_key=("id", "bandate"),
)
IP_BANNED = TableContract(
    "ip_banned",
    (
        Col("ip", "string", False, max_length=32, **_d("0.0.0.0")),
        Col("bandate", "bigint", False),
        Col("unbandate", "bigint", False),
        Col("bannedby", "string", False, max_length=50, **_d("[Console]")),
        Col("banreason", "string", False, max_length=255, **_d("no reason")),
    ),
    primary_key=("ip", "bandate"),
)
REALMCHARACTERS = TableContract(
    "realmcharacters",
    (unsigned("realmid", 32, nullable=False), unsigned("acctid", 32, nullable=False),
     unsigned("numchars", 8, nullable=False, **_d(0))),
    primary_key=("realmid", "acctid"),
)
REALMLIST = TableContract(
    "realmlist",
    (
        unsigned("id", 32, nullable=False),
        Col("name", "string", False, max_length=32, ci=True, **_d("")),
        Col("address", "string", False, max_length=32, **_d("127.0.0.1")),
        Col("port", "int", False, **_d(8085)),
        unsigned("icon", 8, nullable=False, **_d(0)),
        unsigned("realmflags", 8, nullable=False, **_d(2)),
        unsigned("timezone", 8, nullable=False, **_d(0)),
        unsigned("allowedSecurityLevel", 8, nullable=False, **_d(0)),
        Col("population", "float", False, lo=0, **_d(0.0)),
        Col("realmbuilds", "string", False, max_length=64, **_d("")),
    ),
    primary_key=("id",),
    unique=(("name",),),
    generated_key="id",
)
UPTIME = TableContract(
    "uptime",
    (
        unsigned("realmid", 32, nullable=False),
        unsigned("starttime", 64, nullable=False, **_d(0)),
        Col("startstring", "string", False, max_length=64, **_d("")),
        unsigned("uptime", 64, nullable=False, **_d(0)),
        unsigned("maxplayers", 16, nullable=False, **_d(0)),
    ),
    primary_key=("realmid", "starttime"),
)

ACCOUNT_SCHEMA = {c.name: c for c in (REALMD_DB_VERSION, ACCOUNT, ACCOUNT_BANNED, IP_BANNED, REALMCHARACTERS,
                                      REALMLIST, UPTIME)}

# ------------------------------------------------------------------ poll snapshots (same DDL in both)
POLL_CATEGORIES = TableContract(
    "oscars13_categories",
    (
        Col("cat_id", "int", False),
        Col("category", "string", max_length=256),
        Col("img", "string", max_length=256),
        Col("critictext", "string"),
        Col("lastwinner", "string", max_length=100),
        Col("description", "string"),
    ),
    primary_key=("cat_id",),
    generated_key="cat_id",
)
POLL_NOMINEES = TableContract(
    "oscars13_nominees",
    (
        Col("nom_id", "int", False),
        Col("first_name", "string", max_length=256),
        Col("last_name", "string", max_length=256),
        Col("movie", "string", False, max_length=256),
        Col("cat_id", "int"),
        Col("image", "string", max_length=256),
        Col("blurb", "string"),
        Col("story_links", "string"),
        Col("votes", "int"),
    ),
    primary_key=("nom_id",),
    generated_key="nom_id",
)

POLL_SCHEMA = {c.name: c for c in (POLL_CATEGORIES, POLL_NOMINEES)}


# ------------------------------------------------------------------ character database (tables with traps)
def _u(name, bits=32, default=0, **kw):
    """NOT NULL unsigned column with a numeric default (the common form)."""
    if default is None:
        return unsigned(name, bits, nullable=False, **kw)
    return unsigned(name, bits, nullable=False, **_d(default), **kw)


CHARACTER_DB_VERSION = TableContract(
    "character_db_version", (Col("required_z1794_s1350_11716_09_characters_auction", "boolean"),))
AUCTION = TableContract(
    "auction",
    (
        _u("id"), _u("houseid"), _u("itemguid"), _u("item_template"), _u("item_count"),
        Col("item_randompropertyid", "int", False, **_d(0)), _u("itemowner"),
        Col("buyoutprice", "int", False, **_d(0)), _u("time", 64), _u("buyguid"),
        Col("lastbid", "int", False, **_d(0)), Col("startbid", "int", False, **_d(0)),
        Col("deposit", "int", False, **_d(0)),
    ),
    primary_key=("id",),
)
BUGREPORT = TableContract(
    "bugreport",
    (Col("id", "int", False), Col("type", "string", False, **_d("")), Col("content", "string", False, **_d(""))),
    primary_key=("id",),
    generated_key="id",
)
CHARACTER_HONOR_CP = TableContract(
    "character_honor_cp",
    (_u("guid"), _u("victim_type", 8, 4), _u("victim"), Col("honor", "float", False, **_d(0.0)), _u("date"),
     _u("type", 8)),
    # no primary key: the same kill may be recorded twice
)
CHARACTER_SOCIAL = TableContract(
    "character_social",
    # tinyint(1) is a small number here (a flag mask), not a boolean
    (_u("guid"), _u("friend"), _u("flags", 8)),
    primary_key=("guid", "friend", "flags"),
)
CHARACTER_TICKET = TableContract(
    "character_ticket",
    (
        _u("ticket_id", default=None),
        _u("guid"),
        Col("ticket_text", "string"),
        Col("response_text", "string"),
        Col("ticket_lastchange", "timestamp", False, **_d(CURRENT_TIMESTAMP)),
    ),
    primary_key=("ticket_id",),
    generated_key="ticket_id",
    notes={"stamp_on_change": "ticket_lastchange"},  # maintained by touch_on_change (M4)
)
CHARACTER_TUTORIAL = TableContract(
    "character_tutorial",
    (_u("account", 64, default=None), *[_u(f"tut{i}") for i in range(8)]),
    primary_key=("account",),
    generated_key="account",
)
GROUPS = TableContract(
    "groups",
    (
        _u("groupId", default=None), _u("leaderGuid", default=None), _u("mainTank", default=None),
        _u("mainAssistant", default=None), _u("lootMethod", 8, default=None), _u("looterGuid", default=None),
        _u("lootThreshold", 8, default=None), *[_u(f"icon{i}", default=None) for i in range(1, 9)],
        _u("isRaid", 8, default=None),
    ),
    primary_key=("groupId",),
    unique=(("leaderGuid",),),
)
GUILD_EVENTLOG = TableContract(
    "guild_eventlog",
    (
        _u("guildid", default=None), _u("LogGuid", default=None), _u("EventType", 8, default=None),
        _u("PlayerGuid1", default=None), _u("PlayerGuid2", default=None), _u("NewRank", 8, default=None),
        _u("TimeStamp", 64, default=None),  # UNIX seconds: read with from_epoch_seconds (F5)
    ),
    primary_key=("guildid", "LogGuid"),
)
GUILD_MEMBER = TableContract(
    "guild_member",
    (_u("guildid"), _u("guid"), _u("rank", 8), Col("pnote", "string", False, max_length=255, **_d("")),
     Col("offnote", "string", False, max_length=255, **_d(""))),
    unique=(("guid",),),  # a unique key but no primary key
)
ITEM_TEXT = TableContract("item_text", (_u("id"), Col("text", "string")), primary_key=("id",))
MAIL = TableContract(
    "mail",
    (
        _u("id"), _u("messageType", 8), Col("stationery", "tinyint", False, **_d(41)), _u("mailTemplateId", 24),
        _u("sender"), _u("receiver"), Col("subject", "string"), _u("itemTextId"), _u("has_items", 8),
        _u("expire_time", 64), _u("deliver_time", 64), _u("money"), _u("cod"), _u("checked", 8),
    ),
    primary_key=("id",),
)
PETITION = TableContract(
    "petition",
    (_u("ownerguid", default=None), unsigned("petitionguid", 32, **_d(0)),
     Col("name", "string", False, max_length=255, **_d(""))),
    primary_key=("ownerguid",),
    unique=(("ownerguid", "petitionguid"),),  # spans a nullable column: NULL keys never collide
)
PETITION_SIGN = TableContract(
    "petition_sign",
    (_u("ownerguid", default=None), _u("petitionguid"), _u("playerguid"), _u("player_account")),
    primary_key=("petitionguid", "playerguid"),
)
SAVED_VARIABLES = TableContract(
    "saved_variables", (_u("NextMaintenanceDate"), _u("cleaning_flags")),  # no key at all
)
WORLD = TableContract("world", (_u("map"), Col("data", "string")), primary_key=("map",))

CHARACTER_SCHEMA = {
    c.name: c
    for c in (
        CHARACTER_DB_VERSION, AUCTION, BUGREPORT, CHARACTER_HONOR_CP, CHARACTER_SOCIAL, CHARACTER_TICKET,
        CHARACTER_TUTORIAL, GROUPS, GUILD_EVENTLOG, GUILD_MEMBER, ITEM_TEXT, MAIL, PETITION, PETITION_SIGN,
        SAVED_VARIABLES, WORLD,
    )
}


# ------------------------------------------------------------------ character database (plain keyed tables)
def _i(name, default=0):
    """NOT NULL signed int with a default."""
    return Col(name, "int", False, **_d(default))


def _f(name, nonneg=False):
    """NOT NULL float defaulting to 0 (``float unsigned`` gets lo=0; NaN
    then fails the range check)."""
    return Col(name, "float", False, lo=0 if nonneg else None, **_d(0.0))


def _text(name):
    return Col(name, "string")


def _vc(name, n, default=""):
    return Col(name, "string", False, max_length=n, **_d(default))


def _aura_columns():
    return (
        _u("guid"), _u("caster_guid", 64), _u("item_guid"), _u("spell"), _u("stackcount", default=1),
        _u("remaincharges"), _i("basepoints0"), _i("basepoints1"), _i("basepoints2"), _u("periodictime0"),
        _u("periodictime1"), _u("periodictime2"), _i("maxduration"), _i("remaintime"), _u("effIndexMask"),
    )


CHARACTERS = TableContract(
    "characters",
    (
        _u("guid"), _u("account"), _vc("name", 12), _u("race", 8), _u("class", 8), _u("gender", 8), _u("level", 8),
        _u("xp"), _u("money"), _u("playerBytes"), _u("playerBytes2"), _u("playerFlags"),
        _f("position_x"), _f("position_y"), _f("position_z"), _u("map"), _f("orientation"), _text("taximask"),
        _u("online", 8), _u("cinematic", 8), _u("totaltime"), _u("leveltime"), _u("logout_time", 64),
        _u("is_logout_resting", 8), _f("rest_bonus"), _u("resettalents_cost"), _u("resettalents_time", 64),
        _f("trans_x"), _f("trans_y"), _f("trans_z"), _f("trans_o"), _u("transguid", 64), _u("extra_flags"),
        _u("stable_slots", 8), _u("at_login"), _u("zone"), _u("death_expire_time", 64), _text("taxi_path"),
        _u("honor_highest_rank"), _u("honor_standing"), _f("stored_honor_rating"), _i("stored_dishonorable_kills"),
        _i("stored_honorable_kills"), _u("watchedFaction"), _u("drunk", 16), _u("health"),
        *[_u(f"power{i}") for i in range(1, 6)],
        _text("exploredZones"), _text("equipmentCache"), _u("ammoId"), _u("actionBars", 8),
        unsigned("deleteInfos_Account", 32), Col("deleteInfos_Name", "string", max_length=12),
        unsigned("deleteDate", 64),
    ),
    primary_key=("guid",),
)
CHARACTER_ACTION = TableContract(
    "character_action", (_u("guid"), _u("button", 8), _u("action"), _u("type", 8)), primary_key=("guid", "button"))
CHARACTER_AURA = TableContract("character_aura", _aura_columns(),
                               primary_key=("guid", "caster_guid", "item_guid", "spell"))
CHARACTER_BATTLEGROUND_DATA = TableContract(
    "character_battleground_data",
    (_u("guid"), _u("instance_id"), _u("team"), _f("join_x"), _f("join_y"), _f("join_z"), _f("join_o"),
     _i("join_map")),
    primary_key=("guid",),
)
CHARACTER_GIFTS = TableContract(
    "character_gifts", (_u("guid"), _u("item_guid"), _u("entry"), _u("flags")), primary_key=("item_guid",))
CHARACTER_HOMEBIND = TableContract(
    "character_homebind",
    (_u("guid"), _u("map"), _u("zone"), _f("position_x"), _f("position_y"), _f("position_z")),
    primary_key=("guid",),
)
CHARACTER_INSTANCE = TableContract(
    "character_instance", (_u("guid"), _u("instance"), _u("permanent", 8)), primary_key=("guid", "instance"))
CHARACTER_INVENTORY = TableContract(
    "character_inventory", (_u("guid"), _u("bag"), _u("slot", 8), _u("item"), _u("item_template")),
    primary_key=("item",))
CHARACTER_PET = TableContract(
    "character_pet",
    (
        _u("id"), _u("entry"), _u("owner"), unsigned("modelid", 32, **_d(0)), _u("CreatedBySpell"), _u("PetType", 8),
        _u("level", default=1), _u("exp"), _u("Reactstate", 8), _i("loyaltypoints"), _u("loyalty"), _i("trainpoint"),
        Col("name", "string", max_length=100, **_d("Pet")), _u("renamed", 8), _u("slot"), _u("curhealth", default=1),
        _u("curmana"), _u("curhappiness"), _u("savetime", 64), _u("resettalents_cost"), _u("resettalents_time", 64),
        _text("abdata"), _text("teachspelldata"),
    ),
    primary_key=("id",),
)
CHARACTER_QUESTSTATUS = TableContract(
    "character_queststatus",
    (_u("guid"), _u("quest"), _u("status"), _u("rewarded", 8), _u("explored", 8), _u("timer", 64),
     *[_u(f"mobcount{i}") for i in range(1, 5)], *[_u(f"itemcount{i}") for i in range(1, 5)]),
    primary_key=("guid", "quest"),
)
CHARACTER_REPUTATION = TableContract(
    "character_reputation", (_u("guid"), _u("faction"), _i("standing"), _i("flags")), primary_key=("guid", "faction"))
CHARACTER_SKILLS = TableContract(
    "character_skills",
    (_u("guid", default=None), _u("skill", 24, default=None), _u("value", 24, default=None), _u("max", 24, default=None)),
    primary_key=("guid", "skill"),
)
CHARACTER_SPELL = TableContract(
    "character_spell", (_u("guid"), _u("spell"), _u("active", 8, default=1), _u("disabled", 8)),
    primary_key=("guid", "spell"))
CHARACTER_SPELL_COOLDOWN = TableContract(
    "character_spell_cooldown", (_u("guid"), _u("spell"), _u("item"), _u("time", 64)), primary_key=("guid", "spell"))
CHARACTER_STATS = TableContract(
    "character_stats",
    (
        _u("guid"), _u("maxhealth"), *[_u(f"maxpower{i}") for i in range(1, 8)],
        *[_u(c) for c in ("strength", "agility", "stamina", "intellect", "spirit", "armor", "resHoly", "resFire",
                          "resNature", "resFrost", "resShadow", "resArcane")],
        *[_f(c, nonneg=True) for c in ("blockPct", "dodgePct", "parryPct", "critPct", "rangedCritPct")],
        _u("attackPower"), _u("rangedAttackPower"),
    ),
    primary_key=("guid",),
)
CORPSE = TableContract(
    "corpse",
    (_u("guid"), _u("player"), _f("position_x"), _f("position_y"), _f("position_z"), _f("orientation"), _u("map"),
     _u("time", 64), _u("corpse_type", 8), _u("instance")),
    primary_key=("guid",),
)
CREATURE_RESPAWN = TableContract(
    "creature_respawn", (_u("guid"), _u("respawntime", 64), _u("instance", 24)), primary_key=("guid", "instance"))
GAME_EVENT_STATUS = TableContract("game_event_status", (_u("event", 16),), primary_key=("event",))
GAMEOBJECT_RESPAWN = TableContract(
    "gameobject_respawn", (_u("guid"), _u("respawntime", 64), _u("instance", 24)), primary_key=("guid", "instance"))
GROUP_INSTANCE = TableContract(
    "group_instance", (_u("leaderGuid"), _u("instance"), _u("permanent", 8)), primary_key=("leaderGuid", "instance"))
GROUP_MEMBER = TableContract(
    "group_member",
    (_u("groupId", default=None), _u("memberGuid", default=None), _u("assistant", 8, default=None),
     _u("subgroup", 16, default=None)),
    primary_key=("groupId", "memberGuid"),
)
GUILD = TableContract(
    "guild",
    (_u("guildid"), _vc("name", 255), _u("leaderguid"), _i("EmblemStyle"), _i("EmblemColor"), _i("BorderStyle"),
     _i("BorderColor"), _i("BackgroundColor"), Col("info", "string", False), _vc("motd", 255), _u("createdate", 64)),
    primary_key=("guildid",),
)
GUILD_RANK = TableContract(
    "guild_rank", (_u("guildid"), _u("rid", default=None), _vc("rname", 255), _u("rights")),
    primary_key=("guildid", "rid"))
INSTANCE = TableContract(
    "instance", (_u("id"), _u("map"), _u("resettime", 64), _text("data")), primary_key=("id",))
INSTANCE_RESET = TableContract("instance_reset", (_u("mapid"), _u("resettime", 64)), primary_key=("mapid",))
ITEM_INSTANCE = TableContract("item_instance", (_u("guid"), _u("owner_guid"), _text("data")), primary_key=("guid",))
ITEM_LOOT = TableContract(
    "item_loot", (_u("guid"), _u("owner_guid"), _u("itemid"), _u("amount"), _i("property")),
    primary_key=("guid", "itemid"))
MAIL_ITEMS = TableContract(
    "mail_items", (_i("mail_id"), _i("item_guid"), _i("item_template"), _u("receiver")),
    primary_key=("mail_id", "item_guid"))
PET_AURA = TableContract("pet_aura", _aura_columns(), primary_key=("guid", "caster_guid", "item_guid", "spell"))
PET_SPELL = TableContract("pet_spell", (_u("guid"), _u("spell"), _u("active")), primary_key=("guid", "spell"))
PET_SPELL_COOLDOWN = TableContract(
    "pet_spell_cooldown", (_u("guid"), _u("spell"), _u("time", 64)), primary_key=("guid", "spell"))

CHARACTER_SCHEMA.update({
    c.name: c
    for c in (
        CHARACTERS, CHARACTER_ACTION, CHARACTER_AURA, CHARACTER_BATTLEGROUND_DATA, CHARACTER_GIFTS,
        CHARACTER_HOMEBIND, CHARACTER_INSTANCE, CHARACTER_INVENTORY, CHARACTER_PET, CHARACTER_QUESTSTATUS,
        CHARACTER_REPUTATION, CHARACTER_SKILLS, CHARACTER_SPELL, CHARACTER_SPELL_COOLDOWN, CHARACTER_STATS, CORPSE,
        CREATURE_RESPAWN, GAME_EVENT_STATUS, GAMEOBJECT_RESPAWN, GROUP_INSTANCE, GROUP_MEMBER, GUILD, GUILD_RANK,
        INSTANCE, INSTANCE_RESET, ITEM_INSTANCE, ITEM_LOOT, MAIL_ITEMS, PET_AURA, PET_SPELL, PET_SPELL_COOLDOWN,
    )
})

REFERENCE_CONTRACTS = {**NUTRIENT_SCHEMA, **ACCOUNT_SCHEMA, **POLL_SCHEMA, **CHARACTER_SCHEMA}
