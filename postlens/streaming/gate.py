"""Message checks: which messages follow the post schema."""
from pyspark.sql import functions as F

from postlens.constants import REQUIRED_KEYS
from postlens.functions.times import from_text
from postlens.operators.normalize import with_sample_key
from postlens.schema import MESSAGE_SCHEMA, POSTS_SCHEMA


def has_keys(value, required=REQUIRED_KEYS):
    """Whether a JSON text is an object with all keys. A null value counts as present; broken JSON fails."""
    present = F.json_object_keys(value)
    return F.coalesce(F.size(F.array_intersect(present, F.array(*[F.lit(k) for k in required]))) == len(required),
                      F.lit(False))


def gated(messages, required=REQUIRED_KEYS):
    """Messages with an ``accepted`` flag."""
    return messages.withColumn("accepted", has_keys(F.col("value"), required))


def gate_counts(messages, required=REQUIRED_KEYS):
    return gated(messages, required).groupBy("accepted").agg(F.count("*").alias("messages"))


def checked(messages):
    """Parsed fields of every message, ``reason`` (null for usable ones) and ``bad_score`` (a score that is no number).

    Reasons: ``keys`` (broken JSON or a required key missing), ``text`` (null or empty), ``time`` (none that can be read).
    """
    # A generator, so that the tests read its columns and do not parse the message again.
    parsed = F.transform(F.array(F.from_json("value", MESSAGE_SCHEMA)), lambda m: F.struct(
        *[(from_text(m[c]) if c == "created_ts" else m[c].try_cast("double") if c == "orig_score" else m[c]).alias(c)
          for c in MESSAGE_SCHEMA.names],
        (m["orig_score"].isNotNull() & m["orig_score"].try_cast("double").isNull()).alias("bad_score"),
        has_keys(F.col("value")).alias("whole")))
    rows = messages.select("value", F.inline(parsed))
    reason = (F.when(~F.col("whole"), "keys").when(~F.coalesce(F.length("text") > 0, F.lit(False)), "text")
              .when(F.col("created_ts").isNull(), "time"))
    return rows.withColumn("reason", reason).drop("whole")


def stored_form(rows):
    """Checked rows as posts, with the same sample key the bulk path gives them."""
    return with_sample_key(rows).select(POSTS_SCHEMA.names)


def posts_of(messages):
    """Unified posts of the usable messages."""
    return stored_form(checked(messages).where(F.col("reason").isNull()))


def foreign_fields(aside):
    """What the messages set aside consist of: per key and type of its value, the number of messages and whether posts have the key.

    Messages are read as VARIANT, so that unknown keys and changed types are seen as they are. Broken JSON, and JSON that is
    no object, counts under no key.
    """
    rows = aside.select(F.try_parse_json("value").alias("v"))
    fields = rows.lateralJoin(aside.sparkSession.tvf.variant_explode_outer(F.col("v").outer()))
    return fields.groupBy("key", F.schema_of_variant("value").alias("type")).agg(F.count("*").alias("messages")).withColumn(
        "known", F.coalesce(F.col("key").isin(MESSAGE_SCHEMA.names), F.lit(False)))


def with_renamed(aside, names):
    """Messages set aside, written anew as post messages to be sent again: ``names`` maps a foreign key to the field it stands for.

    A field that is there already stays as it is. Broken JSON gives no message.
    """
    def read(key):
        return F.try_variant_get("v", f"$['{key}']", "string")

    fields = [F.coalesce(read(f), *[read(k) for k, field in names.items() if field == f]).alias(f) for f in MESSAGE_SCHEMA.names]
    rows = aside.select(F.try_parse_json("value").alias("v")).where(F.schema_of_variant("v").startswith("OBJECT"))
    return rows.select(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"))
