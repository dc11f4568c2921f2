"""Feed rows.

A feed row is one item of a page: (page, pos, date, platform, deleted_flag, text, ...).
Real feeds arrive as JSON pages (see ``pages.py``). For tests and the registered queries a
feed is *derived* from the ``conversations`` table: every turn becomes one item, with
its text reshaped into one of 16 feed shapes (continuations, media, bare reposts,
links, quotes, blanks, duplicates ...), so every cleaning rule has work to do and the
feed grows with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewrack.session import read_table

FEED_COLUMNS = ("page", "pos", "date", "platform", "deleted_flag", "text")


def derive_feed(conversations: DataFrame) -> DataFrame:
    """conversations(conv_id, turn, role, text) -> feed rows; page = conv_id, pos = turn."""
    c = conversations
    k = (c.conv_id * 7 + c.turn * 3) % 16
    s = lambda x: x.cast("string")
    date = F.when(k == 13, F.lit("2024-01-01T00:00:00-05:00")).otherwise(
        F.concat(
            F.lit("2024-0"), s(1 + c.conv_id % 9), F.lit("-1"), s(c.turn % 10), F.lit("T0"), s(c.conv_id % 10),
            F.lit(":3"), s(c.turn % 10), F.lit(":00"),
            F.when(c.conv_id % 2 == 0, F.lit("-04:00")).otherwise(F.lit("-05:00")),
        )
    )
    t = c.text
    text = (
        F.when(k == 0, F.concat(F.lit("..."), t))
        .when(k == 1, F.concat(F.lit("....  "), t))
        .when(k == 2, F.concat(t, F.lit(" : https://t.co/x"), s(c.turn)))
        .when(k == 3, F.lit("[Image]"))
        .when(k == 4, F.concat(F.lit("RT @user_"), s(c.conv_id), F.lit(".")))
        .when(k == 5, F.concat(F.lit("https:// example.com/a b/"), s(c.conv_id)))
        .when(k == 6, F.concat(F.lit("RT @FoxNews: "), t))
        .when(k == 7, F.concat(F.lit("“"), t, F.lit("” - @FoxNews")))
        .when(k == 8, F.concat(F.lit("— "), t, F.lit(" …")))
        .when(k == 9, F.lit(None).cast("string"))
        .when(k == 10, F.lit("   "))
        .when(k == 11, F.concat(F.lit("pic.twitter.com/aB"), s(c.turn)))
        .when(k == 12, F.concat(t, F.lit(" -- w/ #MakeItGreat @FoxNews !!!")))
        .when(k == 13, F.lit("Same post, same time"))
        .otherwise(t)
    )
    return c.select(
        c.conv_id.alias("page"),
        c.turn.alias("pos"),
        date.alias("date"),
        F.when(c.conv_id % 3 == 0, F.lit("Truth Social")).otherwise(F.lit("Twitter")).alias("platform"),
        ((c.conv_id + c.turn) % 17 == 0).alias("deleted_flag"),
        text.alias("text"),
    )


def load_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_feed(read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"))


# DuckDB/ANSI form of the same derivation, used by the oracles.
FEED_SQL = """
SELECT conv_id AS page, turn AS pos,
 CASE WHEN k = 13 THEN '2024-01-01T00:00:00-05:00'
      ELSE concat('2024-0', CAST(1 + conv_id % 9 AS VARCHAR), '-1', CAST(turn % 10 AS VARCHAR), 'T0',
                  CAST(conv_id % 10 AS VARCHAR), ':3', CAST(turn % 10 AS VARCHAR), ':00',
                  CASE WHEN conv_id % 2 = 0 THEN '-04:00' ELSE '-05:00' END) END AS date,
 CASE WHEN conv_id % 3 = 0 THEN 'Truth Social' ELSE 'Twitter' END AS platform,
 (conv_id + turn) % 17 = 0 AS deleted_flag,
 CASE k
  WHEN 0 THEN concat('...', text) WHEN 1 THEN concat('....  ', text)
  WHEN 2 THEN concat(text, ' : https://t.co/x', CAST(turn AS VARCHAR))
  WHEN 3 THEN '[Image]' WHEN 4 THEN concat('RT @user_', CAST(conv_id AS VARCHAR), '.')
  WHEN 5 THEN concat('https:// example.com/a b/', CAST(conv_id AS VARCHAR))
  WHEN 6 THEN concat('RT @FoxNews: ', text) WHEN 7 THEN concat('“', text, '” - @FoxNews')
  WHEN 8 THEN concat('— ', text, ' …') WHEN 9 THEN NULL WHEN 10 THEN '   '
  WHEN 11 THEN concat('pic.twitter.com/aB', CAST(turn AS VARCHAR))
  WHEN 12 THEN concat(text, ' -- w/ #MakeItGreat @FoxNews !!!')
  WHEN 13 THEN 'Same post, same time' ELSE text END AS text
FROM (SELECT *, (conv_id * 7 + turn * 3) % 16 AS k FROM conversations) c
"""
