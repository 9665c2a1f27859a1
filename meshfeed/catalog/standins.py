"""Feed inputs derived from the test tables, in Spark and as SQL.

The test tables have no nested lists and no nulls, so both are derived from real columns:
the lists from the words of a text, the nulls from one value of a column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meshfeed.catalog.registry import table
from meshfeed.plans.site_alert import FEATURES

WORDS = ("the", "of", "and", "to", "a", "in")
ANON_WORDS = ("de", "the", "der")
LINK_PREFIX = "https://reports.example.org/site?id="


def words_sql(words: tuple[str, ...]) -> str:
    return ", ".join(f"'{w}'" for w in words)


def word_lists(df: DataFrame, text: str, into: str) -> DataFrame:
    """Lines of words: an array of arrays.

    It is made by a one-element explode, so that it is a column like one read from a file. As a
    projected expression the optimizer would copy it into the filters it puts below an explode,
    and every text would be split three times.
    """
    lists = F.transform(F.split(F.col(text), "\n"), lambda line: F.split(line, " "))
    return df.withColumn(into, F.explode(F.array(lists)))


WORD_LISTS_SQL = "list_transform(string_split(text, chr(10)), lambda line: string_split(line, ' '))"


def routers(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn = F.col("turn")
    return word_lists(table(spark, sf_dir, "conversations"), "text", "dg_model").select(
        F.concat(F.lit("sn-"), F.col("conv_id").cast("string")).alias("serial_num"),
        F.nullif(F.col("role"), F.lit("system")).alias("mdn"),
        F.nullif(turn.cast("string"), F.lit("0")).alias("cust_id"),
        F.concat(F.lit("2024-01-"), F.lpad((turn + 1).cast("string"), 2, "0")).alias("date"),
        (turn * 0.25).cast("float").alias("poor_rssi"),
        (turn * 0.5).cast("float").alias("poor_phyrate"),
        F.nullif(turn, F.lit(3)).cast("float").alias("num_station"),
        (100 - turn * 2.5).cast("float").alias("home_score"),
        "dg_model",
    )


def router_words_sql(words: tuple[str, ...], columns: str) -> str:
    """Distinct rows of the given columns for routers that have one of the words."""
    return f"""
    select distinct {columns} from (
      select * exclude (words), unnest(words) as dg_model_indiv from (
        select
          'sn-' || conv_id as serial_num,
          nullif(role, 'system') as mdn,
          nullif(cast(turn as varchar), '0') as cust_id,
          '2024-01-' || lpad(cast(turn + 1 as varchar), 2, '0') as "date",
          cast(turn * 0.25 as float) as poor_rssi,
          cast(turn * 0.5 as float) as poor_phyrate,
          cast(nullif(turn, 3) as float) as num_station,
          cast(100 - turn * 2.5 as float) as home_score,
          unnest({WORD_LISTS_SQL}) as words
        from conversations))
    where dg_model_indiv in ({words_sql(words)})"""


def _flag(raised: Column, unknown: Column) -> Column:
    return F.when(unknown, F.lit(None)).when(raised, F.lit("1")).otherwise(F.lit("0"))


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site measurements, every column text."""
    quantity, discount, number = F.col("l_quantity"), F.col("l_discount"), F.col("l_linenumber")
    measured = {
        "sip_dc_rate": F.nullif(quantity, F.lit(7.0)),
        "rrc_setup_failure": discount,
        "bearer_drop_rate": F.col("l_tax"),
        "rtp_gap": F.nullif(number, F.lit(4)),
        "avgconnected_users": F.col("l_partkey"),
        "dl_data_volume": F.col("l_extendedprice"),
        "uptp_user_perceived_throughput": F.col("l_suppkey"),
    }
    alerts = {
        "sip_dc_rate": _flag(quantity > 25, number == 2),
        "rrc_setup_failure": _flag(discount > 0.04, number == 3),
        "bearer_drop_rate": F.when(F.col("l_tax") > 0.05, "1").otherwise("0.0"),
        "rtp_gap": _flag(number > 3, quantity == 10),
        "avgconnected_users": _flag(F.col("l_returnflag") == "A", number == 5),
        "dl_data_volume": F.lit("0"),
        "uptp_user_perceived_throughput": _flag(F.col("l_linestatus") == "O", quantity == 11),
    }
    abnormal = (
        F.when(discount > 0.07, "1")
        .when(discount > 0.05, "1.0")
        .when(discount > 0.03, "")
        .when(discount > 0.02, "n/a")
        .otherwise("0")
    )
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("enodeb"),
        F.col("l_shipdate").cast("date").cast("string").alias("day"),
        F.date_sub(F.col("l_shipdate").cast("date"), 1).cast("string").alias("event_day"),
        F.concat(F.lit("site-"), F.col("l_suppkey").cast("string")).alias("site"),
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("region"),
        number.cast("string").alias("abnormal_kpi"),
        *[measured[f].cast("string").alias(f) for f in FEATURES],
        F.lit("0").alias("nrb_ticket_counts"),
        F.nullif(number.cast("string"), F.lit("1")).alias("w360_ticket_counts"),
        *[alerts[f].alias(f"{f}_alert") for f in FEATURES],
        abnormal.alias("has_abnormal_kpi"),
    )


SITES_SQL = """
    select
      cast(l_orderkey as varchar) as enodeb,
      cast(cast(l_shipdate as date) as varchar) as "day",
      cast(cast(l_shipdate as date) - 1 as varchar) as event_day,
      'site-' || l_suppkey as site,
      nullif(l_returnflag, 'N') as region,
      cast(l_linenumber as varchar) as abnormal_kpi,
      cast(nullif(l_quantity, 7) as varchar) as sip_dc_rate,
      cast(l_discount as varchar) as rrc_setup_failure,
      cast(l_tax as varchar) as bearer_drop_rate,
      cast(nullif(l_linenumber, 4) as varchar) as rtp_gap,
      cast(l_partkey as varchar) as avgconnected_users,
      cast(l_extendedprice as varchar) as dl_data_volume,
      cast(l_suppkey as varchar) as uptp_user_perceived_throughput,
      '0' as nrb_ticket_counts,
      nullif(cast(l_linenumber as varchar), '1') as w360_ticket_counts,
      case when l_linenumber = 2 then null when l_quantity > 25 then '1' else '0' end
        as sip_dc_rate_alert,
      case when l_linenumber = 3 then null when l_discount > 0.04 then '1' else '0' end
        as rrc_setup_failure_alert,
      case when l_tax > 0.05 then '1' else '0.0' end as bearer_drop_rate_alert,
      case when l_quantity = 10 then null when l_linenumber > 3 then '1' else '0' end
        as rtp_gap_alert,
      case when l_linenumber = 5 then null when l_returnflag = 'A' then '1' else '0' end
        as avgconnected_users_alert,
      '0' as dl_data_volume_alert,
      case when l_quantity = 11 then null when l_linestatus = 'O' then '1' else '0' end
        as uptp_user_perceived_throughput_alert,
      l_discount
    from lineitem"""


def gated_json_sql(features: tuple[str, ...]) -> str:
    """JSON object of the features whose flag is raised."""
    members = ", ".join(
        f"{f} := case when coalesce({f}_alert, '0') <> '0' then {f} end" for f in features
    )
    return f"json_merge_patch('{{}}', to_json(struct_pack({members})))"


def activations(spark: SparkSession, sf_dir: str, date_names: str = "date_") -> DataFrame:
    """Activation rows with clock parts, numbers, three dates and a score that may be missing."""
    ts = F.col("ts")
    day = ts.cast("date")
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "event_type",
        F.hour(ts).alias("hr"),
        F.minute(ts).alias("mins"),
        F.floor(F.second(ts)).alias("sec"),
        F.col("user_id").alias("mdn1"),
        F.col("user_id").alias("mdn2"),
        F.col("user_id").alias("mdn3"),
        day.alias(f"{date_names}1"),
        F.date_sub(day, 1).alias(f"{date_names}2"),
        F.date_sub(day, 2).alias(f"{date_names}3"),
        F.when(F.col("event_type") != "signup", F.col("value")).alias("AVG_SCORE_1_3"),
    )


ACTIVATION_JSON_SQL = """
    cast(json_merge_patch('{}', to_json(struct_pack(
      event_id := event_id,
      user_id := user_id,
      event_type := event_type,
      outage_date_1 := cast(cast(ts as date) as varchar),
      outage_date_2 := cast(cast(ts as date) - 1 as varchar),
      outage_date_3 := cast(cast(ts as date) - 2 as varchar),
      AVG_SCORE_1_3 := case when event_type <> 'signup' then value end))) as varchar)"""


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score messages as text; one event type gives a line that is no JSON."""
    score = F.to_json(
        F.struct(
            F.col("event_id").cast("string").alias("serial_num"),
            F.col("user_id").alias("mdn"),
            F.col("event_type").alias("cust_id"),
            F.col("ts").cast("date").cast("string").alias("date"),
            F.col("value").cast("float").alias("home_score"),
            F.lit("dropped").alias("not_in_schema"),
        )
    )
    return table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") == "error", "bad").otherwise(score).alias("value")
    )


EVENT_MESSAGES_SQL = """
    select
      case when event_type <> 'error' then cast(event_id as varchar) end as serial_num,
      case when event_type <> 'error' then cast(user_id as varchar) end as mdn,
      case when event_type <> 'error' then event_type end as cust_id,
      case when event_type <> 'error' then cast(cast(ts as date) as varchar) end as "date",
      cast(null as float) as poor_rssi,
      cast(null as float) as poor_phyrate,
      cast(null as float) as num_station,
      case when event_type <> 'error' then cast(value as float) end as home_score,
      cast(null as varchar) as dg_model_indiv
    from events"""


def location_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Location events as message text; one event type has no longitude, one no location."""
    user = F.col("user_id").cast("string")
    place = (
        F.when(F.col("event_type") == "view", F.create_map(F.lit("latitude"), user))
        .when(
            F.col("event_type") != "click",
            F.create_map(F.lit("latitude"), user, F.lit("longitude"), F.col("event_type")),
        )
    )
    return table(spark, sf_dir, "events").select(
        F.to_json(
            F.struct(
                F.col("event_id").cast("int").alias("eventType"),
                place.alias("location"),
                F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"),
                F.col("props").alias("data"),
            )
        ).alias("value")
    )


LOCATION_SQL = """
    select
      cast(event_id as int) as "eventType",
      epoch_us(ts) // 1000 as "timestamp",
      props as data,
      strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') as date_parsed,
      case when event_type <> 'click' then cast(user_id as varchar) end as latitude,
      case when event_type not in ('click', 'view') then event_type end as longitude,
      cast(hour(ts) as int) as "hour",
      cast(ts as date) as "date"
    from events"""
