"""Text jobs over the driver's tables: word count, scalar functions, log roll-up."""

from __future__ import annotations

from pyspark.sql import functions as F

from coview.functions.scalars import (
    ci_equals, dot, drop_first_field, java_split, sigmoid, stable_round,
)
from coview.operators.logs import log_rollup
from coview.operators.text import lines_of, word_count
from coview.plans.registry import register
from coview.plans.tables import table
from coview.sources.readers import ACCESS_LOG_PATTERN

# --- A9 + S1 + X1: word count over every line of every document ---------------------

SQL_JAVA_SPLIT_WORDS = r"""
lines AS (
  SELECT unnest(CASE WHEN text = '' THEN []::VARCHAR[]
                     ELSE string_split_regex(regexp_replace(text, '(\r\n|\r|\n)\z', ''),
                                             '\r\n|\r|\n') END) AS line
  FROM documents),
words AS (
  SELECT unnest(CASE WHEN line = '' THEN ['']
                     WHEN regexp_replace(line, '( )+\z', '') = '' THEN []::VARCHAR[]
                     ELSE string_split(regexp_replace(line, '( )+\z', ''), ' ') END) AS word
  FROM lines)"""


@register("word_count", oracle="WITH " + SQL_JAVA_SPLIT_WORDS
          + "\nSELECT word, count(*) AS n FROM words GROUP BY word")
def q_word_count(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("text")
    return word_count(lines_of(docs))


# --- X1 X2 X3 X8 X11: text scalars on a comma line per customer --------------------

@register("text_scalars", oracle="""
WITH l AS (
  SELECT c_custkey, concat_ws(',', CAST(c_custkey AS VARCHAR), ' ' || c_name || ' ',
                              c_mktsegment, CAST(c_nationkey AS VARCHAR)) AS line
  FROM customer)
SELECT CAST(split_part(line, ',', 1) AS BIGINT) AS key,
       trim(split_part(line, ',', 2)) AS name,
       lower(split_part(line, ',', 3)) = lower('building') AS is_building,
       CAST(trim(split_part(line, ',', 4)) AS INTEGER) AS nation,
       CAST(len(string_split(line, ',')) AS INTEGER) AS n_fields,
       array_to_string(string_split(line, ',')[2:], ',') AS rest
FROM l""")
def q_text_scalars(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    line = F.concat_ws(",", F.col("c_custkey").cast("string"),
                       F.concat(F.lit(" "), F.col("c_name"), F.lit(" ")),
                       "c_mktsegment", F.col("c_nationkey").cast("string"))
    l = c.select(line.alias("line"))
    parts = java_split(F.col("line"), ",")
    return l.select(
        parts[0].cast("long").alias("key"),
        F.trim(parts[1]).alias("name"),
        ci_equals(parts[2], "BUILDING").alias("is_building"),
        F.trim(parts[3]).cast("int").alias("nation"),
        F.size(parts).alias("n_fields"),
        drop_first_field(F.col("line"), ",").alias("rest"))


# --- X4 X10: math scalars ------------------------------------------------------------

MATH_WEIGHTS = (0.02, -3.0, 5.0)


@register("math_scalars", oracle=f"""
SELECT l_orderkey, l_linenumber,
       round(ln(1 + l_quantity) + 1e-9, 6) AS ln_q,
       round(sqrt(l_extendedprice) + 1e-9, 6) AS sqrt_price,
       round(exp(-l_discount) + 1e-9, 6) AS exp_disc,
       round(l_quantity * {MATH_WEIGHTS[0]} + l_discount * {MATH_WEIGHTS[1]}
             + l_tax * {MATH_WEIGHTS[2]} + 1e-9, 6) AS dot,
       round(1 / (1 + exp(-(l_quantity * {MATH_WEIGHTS[0]} + l_discount * {MATH_WEIGHTS[1]}
             + l_tax * {MATH_WEIGHTS[2]}))) + 1e-9, 6) AS sigmoid
FROM lineitem""")
def q_math_scalars(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    d = dot(["l_quantity", "l_discount", "l_tax"], MATH_WEIGHTS)
    return li.select(
        "l_orderkey", "l_linenumber",
        stable_round(F.log(F.lit(1.0) + F.col("l_quantity"))).alias("ln_q"),
        stable_round(F.sqrt("l_extendedprice")).alias("sqrt_price"),
        stable_round(F.exp(-F.col("l_discount"))).alias("exp_disc"),
        stable_round(d).alias("dot"),
        stable_round(sigmoid(d)).alias("sigmoid"))


# --- A10 + S16 + F12: access-log roll-up over log lines built from events -----------

def access_lines(events):
    """One access-log line per event; error events give lines that do not match,
    signups log in as ``-``, and every 97th event logs ``-`` bytes."""
    ip = F.concat(F.lit("10.1."), F.expr("CAST(user_id div 256 AS STRING)"), F.lit("."),
                  F.expr("CAST(user_id % 256 AS STRING)"))
    user = F.when(F.col("event_type") == "signup", F.lit("-")).otherwise(
        F.concat(F.lit('"'), F.upper("event_type"), F.lit('"')))
    request = F.concat(F.lit("GET /item/"), F.get_json_object("props", "$.k"), F.lit(" HTTP/1.1"))
    nbytes = F.when(F.col("event_id") % 97 == 0, F.lit("-")).otherwise(
        ((F.col("event_id") * 37) % 5000).cast("string"))
    when = F.concat(F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(" +0000"))
    good = F.concat(ip, F.lit(" - "), user, F.lit(" ["), when, F.lit('] "'), request,
                    F.lit('" 200 '), nbytes, F.lit(' "http://ref.example/" "agent/1.0" extra'))
    bad = F.concat(F.lit("malformed request "), F.col("event_id").cast("string"))
    return events.select(F.when(F.col("event_type") == "error", bad).otherwise(good).alias("value"))


SQL_ACCESS_LINES = """lines AS (
  SELECT CASE WHEN event_type = 'error' THEN 'malformed request ' || CAST(event_id AS VARCHAR)
  ELSE '10.1.' || CAST(user_id // 256 AS VARCHAR) || '.' || CAST(user_id % 256 AS VARCHAR)
       || ' - ' || CASE WHEN event_type = 'signup' THEN '-' ELSE '"' || upper(event_type) || '"' END
       || ' [' || strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' +0000] "GET /item/'
       || json_extract_string(props, '$.k') || ' HTTP/1.1" 200 '
       || CASE WHEN event_id % 97 = 0 THEN '-' ELSE CAST((event_id * 37) % 5000 AS VARCHAR) END
       || ' "http://ref.example/" "agent/1.0" extra' END AS value
  FROM events)"""


@register("log_rollup", oracle=f"""
WITH {SQL_ACCESS_LINES},
p AS (SELECT regexp_matches(value, '{ACCESS_LOG_PATTERN}') AS matched,
             regexp_extract(value, '{ACCESS_LOG_PATTERN}', 1) AS ip,
             regexp_extract(value, '{ACCESS_LOG_PATTERN}', 3) AS usr,
             regexp_extract(value, '{ACCESS_LOG_PATTERN}', 5) AS request,
             regexp_extract(value, '{ACCESS_LOG_PATTERN}', 7) AS b FROM lines),
k AS (SELECT CASE WHEN matched AND lower(usr) <> '-' THEN ip END AS ip,
             CASE WHEN matched AND lower(usr) <> '-' THEN usr END AS usr,
             CASE WHEN matched AND lower(usr) <> '-' THEN request END AS request,
             CASE WHEN matched THEN coalesce(TRY_CAST(b AS BIGINT), 0) ELSE 0 END AS bytes
      FROM p)
SELECT ip, usr AS "user", request, count(*) AS n, CAST(sum(bytes) AS BIGINT) AS bytes
FROM k GROUP BY ip, usr, request""")
def q_log_rollup(spark, sf_dir):
    return log_rollup(access_lines(table(spark, sf_dir, "events")))
