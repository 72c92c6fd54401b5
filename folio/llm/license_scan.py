"""License scans (operator 9), with DataFrame functions only.

Method: *sentence-rule recognition*.  A text is cut into sentences (at line
ends, and after . ! ? before white space); each is normalised (lower case, runs
of other characters than letters and digits become one space); a normalised
sentence found in the table of known licence sentences gets its identifier;
the document's identifiers in order are matched against ordered licence rules
(sequences of identifiers).  Sentences between two identifiers may be at most
``max_gap`` unknown ones within one rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.llm.common import table

# Known sentences (identifier, sentence), from the public texts of the licences.
SENTENCES = [
    ("apache2_under", "Licensed under the Apache License, Version 2.0."),
    ("apache2_under_the_license", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("apache2_compliance", "you may not use this file except in compliance with the License."),
    ("apache2_copy", "You may obtain a copy of the License at"),
    ("mit_released", "Released under the MIT License."),
    ("mit_licensed", "Licensed under the MIT License."),
    ("mit_name", "The MIT License (MIT)"),
    ("mit_name_short", "MIT License"),
    ("mit_notice", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("gpl3_work", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl3_program", "This program is licensed under the GNU General Public License, version 3."),
    ("gpl_hope", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;"),
    ("ccbync4_under", "Licensed under CC BY-NC 4.0."),
    ("ccby4_under", "Licensed under CC BY 4.0."),
    ("bsd_binary", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("reserved", "All rights reserved."),
]
# Rules (rule, licence, identifiers in order).
RULES = [
    ("apache2-line", "Apache-2.0", ["apache2_under"]),
    ("apache2-header", "Apache-2.0", ["apache2_under_the_license", "apache2_compliance", "apache2_copy"]),
    ("apache2-head", "Apache-2.0", ["apache2_under_the_license"]),
    ("mit-line", "MIT", ["mit_released"]),
    ("mit-licensed", "MIT", ["mit_licensed"]),
    ("mit-text", "MIT", ["mit_name", "mit_notice"]),
    ("mit-text-short", "MIT", ["mit_name_short", "mit_notice"]),
    ("gpl3-line", "GPL-3.0-only", ["gpl3_work"]),
    ("gpl3-program", "GPL-3.0-only", ["gpl3_program", "gpl_hope"]),
    ("gpl3-program-line", "GPL-3.0-only", ["gpl3_program"]),
    ("ccbync4-line", "CC-BY-NC-4.0", ["ccbync4_under"]),
    ("ccby4-line", "CC-BY-4.0", ["ccby4_under"]),
    ("bsd3-clause", "BSD-3-Clause", ["bsd_binary"]),
    ("reserved-then-apache2", "Apache-2.0 with rights reserved", ["reserved", "apache2_under"]),
    ("reserved-line", "all-rights-reserved", ["reserved"]),
]
MAX_GAP = 2
BROADCAST_SENTENCES = 50_000  # a larger table of sentences is joined by shuffle
SENTENCE_END = r"[\n\r]+|(?<=[.!?;])[ \t]+"


def normalised(sentence):
    """Lower case; every run of characters other than letters and digits is one space; trimmed."""
    return F.trim(F.regexp_replace(F.lower(sentence), r"[^\p{L}\p{N}]+", " "))


def knowledge(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """The tables of sentences (ident, sentence) and rules (rule, license, idents)."""
    return (
        spark.createDataFrame(SENTENCES, "ident string, sentence string"),
        spark.createDataFrame(RULES, "rule string, license string, idents array<string>"),
    )


def scan_licenses(docs: DataFrame, sentences: DataFrame, rules: DataFrame, max_gap: int = MAX_GAP) -> DataFrame:
    """One row per document row and recognised rule occurrence:
    doc_id, license, rule, first_sentence (from 0), last_sentence, n_sentences.

    An occurrence is dropped only if a longer occurrence of the same document
    row covers the same first sentence; ties by rule name.  Null and empty texts,
    and texts without a known sentence, give no row; null doc_ids and repeated
    rows give their own rows.  The two knowledge tables are
    the caller's own; the sentences are broadcast up to BROADCAST_SENTENCES."""
    known = sentences.select(normalised(F.col("sentence")).alias("norm"), "ident").filter("norm != ''").groupBy("norm").agg(F.min("ident").alias("ident"))
    # a sentence of another length than the known ones is not normalised at all
    low, high, n = known.agg(F.coalesce(F.min(F.length("norm")), F.lit(0)), F.coalesce(F.max(F.length("norm")), F.lit(-1)), F.count("*")).first()
    known = F.broadcast(known) if n <= BROADCAST_SENTENCES else known
    found = (
        docs.select(F.monotonically_increasing_id().alias("_row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
        .select("_row", "doc_id", F.posexplode(F.split("text", SENTENCE_END)).alias("pos", "_s"))
        .filter(F.length("_s") >= low)
        .withColumn("norm", normalised(F.col("_s")))
        .filter(F.length("norm").between(low, high))
        .join(known, "norm")
        .groupBy("_row", "doc_id")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "ident"))).alias("seq"))
    )
    # every position of the identifier sequence is tried as the start of the rules that begin with its identifier
    ruled = rules.filter(F.size("idents") > 0).withColumn("ident", F.element_at("idents", 1))
    longest = ruled.agg(F.coalesce(F.max(F.size("idents")), F.lit(1))).first()[0]
    ahead = F.transform("seq", lambda x, i: F.slice("seq", i + 1, F.lit(longest)))
    starts = found.select("_row", "doc_id", F.explode(ahead).alias("seq")).withColumn("_first", F.element_at("seq", 1)).withColumn("ident", F.col("_first.ident"))
    part = F.slice("seq", F.lit(1), F.size("idents"))
    steps_ok = F.forall(
        F.sequence(F.lit(0), F.size("part") - 1),
        lambda k: (k == 0) | (F.get("part", k)["pos"] - F.get("part", k - 1)["pos"] <= max_gap + 1),
    )
    hits = (
        starts.join(ruled, "ident")
        .withColumn("part", part)
        .filter((F.transform("part", lambda x: x["ident"]) == F.col("idents")) & steps_ok)
        .select("_row", "doc_id", "license", "rule", F.col("_first.pos").alias("first_sentence"), F.element_at("part", -1)["pos"].alias("last_sentence"), F.size("idents").alias("n_sentences"))
    )
    best = hits.groupBy("_row", "doc_id", "first_sentence").agg(
        F.min(F.struct((-F.col("n_sentences")).alias("k"), "rule", "license", "last_sentence", "n_sentences")).alias("b")
    )
    return best.select("doc_id", "b.license", "b.rule", F.col("first_sentence").cast("long"), F.col("b.last_sentence").cast("long").alias("last_sentence"), F.col("b.n_sentences").cast("long").alias("n_sentences"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"), *knowledge(spark))


def oracle() -> str:
    """The rules of one to three identifiers, in DuckDB SQL."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    sentences = ", ".join(f"({quote(i)}, {quote(s)})" for i, s in SENTENCES)
    rules = ", ".join(f"({quote(r)}, {quote(lic)}, [{', '.join(map(quote, ids))}])" for r, lic, ids in RULES)
    norm = "trim(regexp_replace(lower({}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
    return f"""
WITH s(ident, sentence) AS (VALUES {sentences}), rules(rule, license, idents) AS (VALUES {rules}),
known AS (SELECT {norm.format("sentence")} AS norm, min(ident) AS ident FROM s GROUP BY 1),
d AS (SELECT row_number() OVER () AS r, doc_id,
             string_split(regexp_replace(regexp_replace(text, '[\\n\\r]+', chr(1), 'g'), '([.!?;])[ \\t]+', '\\1' || chr(1), 'g'), chr(1)) AS parts
      FROM documents),
e AS (SELECT r, doc_id, unnest(parts) AS sentence, generate_subscripts(parts, 1) - 1 AS pos FROM d),
f AS (SELECT r, doc_id, pos, known.ident AS ident FROM e JOIN known ON {norm.format("e.sentence")} = known.norm),
g AS (SELECT r, doc_id, pos, ident,
             lead(ident, 1) OVER w AS i2, lead(pos, 1) OVER w AS p2, lead(ident, 2) OVER w AS i3, lead(pos, 2) OVER w AS p3
      FROM f WINDOW w AS (PARTITION BY r ORDER BY pos)),
h AS (SELECT r, doc_id, pos, rule, license, len(idents) AS n,
             CASE len(idents) WHEN 1 THEN pos WHEN 2 THEN p2 ELSE p3 END AS last_pos
      FROM g JOIN rules ON idents[1] = ident
       AND (len(idents) < 2 OR (idents[2] = i2 AND p2 - pos <= {MAX_GAP + 1}))
       AND (len(idents) < 3 OR (idents[3] = i3 AND p3 - p2 <= {MAX_GAP + 1}))),
k AS (SELECT *, row_number() OVER (PARTITION BY r, pos ORDER BY n DESC, rule) AS best FROM h)
SELECT doc_id, license, rule, CAST(pos AS BIGINT) AS first_sentence, CAST(last_pos AS BIGINT) AS last_sentence, CAST(n AS BIGINT) AS n_sentences
FROM k WHERE best = 1"""
