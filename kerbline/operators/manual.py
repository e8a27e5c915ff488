"""Manuals of nested sections as a table of passages.

A manual is JSON of three levels, parts with chapters with sections, each with its number and title, and paragraphs at
the bottom.  A section's text is its paragraphs joined by line ends.  Sections of fewer than :data:`LEAST` characters
are left out; a section of more than :data:`MOST` is cut behind the last sentence end that fits, or hard where none
does, into numbered passages, which joined give back the section.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEAST, MOST = 50, 8000
_SECTION = "section: string, title: string, paragraphs: array<string>"
SCHEMA = f"manual bigint, parts array<struct<part: string, title: string, chapters: array<struct<chapter: string, title: string, sections: array<struct<{_SECTION}>>>>>>"


def read_manuals(spark: SparkSession, path: str) -> DataFrame:
    """A row per manual, of a JSON document per line."""
    return spark.read.schema(SCHEMA).json(path)


def sections(manuals: DataFrame) -> DataFrame:
    """manual, path, title, body: a row per section; paragraphs that are null are left out."""
    parts = manuals.select("manual", F.explode("parts").alias("p"))
    chapters = parts.select("manual", "p.part", F.explode("p.chapters").alias("c"))
    rows = chapters.select("manual", "part", "c.chapter", F.explode("c.sections").alias("s"))
    path = F.concat_ws(" > ", F.concat(F.lit("Part "), "part"), F.concat(F.lit("Chapter "), "chapter"), F.concat(F.lit("Section "), "s.section"))
    return rows.select("manual", path.alias("path"), F.col("s.title").alias("title"), F.array_join("s.paragraphs", "\n").alias("body"))


def cut(text, most: int = MOST):
    """Passages of a text: whole to the end where it fits, else up to the last sentence end that fits, else ``most`` characters."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{most}}}\z|.{{0,{most - 2}}}[.!?][ \n]|.{{1,{most}}}"), F.lit(0))


def passages(manuals: DataFrame, least: int = LEAST, most: int = MOST) -> DataFrame:
    """manual, path, title, passage (from 1), text."""
    long = sections(manuals).where(F.length("body") >= least)
    return long.select("manual", "path", "title", F.posexplode(cut(F.col("body"), most)).alias("k", "text")).select("manual", "path", "title", (F.col("k") + 1).alias("passage"), "text")
