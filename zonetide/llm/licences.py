"""Licence scans: texts are normalised to one canonical form, and their digests are joined to those of known licences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonetide.llm.common import cut, texts
from zonetide.llm.licence_digests import DIGESTS

#: Spellings and wordings that licence texts use for one another, the second form being the canonical one.
EQUIVALENT = (
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("sub license", "sublicense"),
    ("acknowledgement", "acknowledgment"),
    ("analyse", "analyze"),
    ("artefact", "artifact"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("calibre", "caliber"),
    ("cancelled", "canceled"),
    ("centre", "center"),
    ("copyright owner", "copyright holder"),
    ("copyright owners", "copyright holders"),
    ("emphasised", "emphasized"),
    ("endeavour", "endeavor"),
    ("favour", "favor"),
    ("fulfil", "fulfill"),
    ("initialise", "initialize"),
    ("labelling", "labeling"),
    ("modelling", "modeling"),
    ("non commercial", "noncommercial"),
    ("optimise", "optimize"),
    ("organisation", "organization"),
    ("per cent", "percent"),
    ("practise", "practice"),
    ("programme", "program"),
    ("realise", "realize"),
    ("recognise", "recognize"),
    ("signalling", "signaling"),
    ("utilisation", "utilization"),
    ("whilst", "while"),
    ("wilful", "willful"),
    ("http", "https"),
)

#: What the BSD licences share.
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution.\n\n"
)
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission.\n\n"
)
_BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
    "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)

#: Short licence texts and notices, each whole; DIGESTS holds longer ones. A table
#: of the same columns may be passed in instead.
KNOWN = (
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\nThe above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT "
        "SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
        "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN "
        "THE SOFTWARE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE "
        "IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
        "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
        "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE.",
    ),
    ("BSD-2-Clause", _BSD + _BSD_END),
    ("BSD-3-Clause", _BSD + _BSD_NAMES + _BSD_END),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE "
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY "
        "SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
        "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH "
        "THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software.\n\nPermission is granted to anyone to use this "
        "software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to "
        "the following restrictions:\n\n1. The origin of this software must not be misrepresented; you must not claim that you "
        "wrote the original software. If you use this software in a product, an acknowledgment in the product documentation "
        "would be appreciated but is not required.\n\n2. Altered source versions must be plainly marked as such, and must not "
        "be misrepresented as being the original software.\n\n3. This notice may not be removed or altered from any source "
        "distribution.",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
)

#: Starts of known licences, and their digests, that may be broadcast, at some 40 and 120 bytes each; beyond, parts are shuffled.
MAX_STARTS = 100_000
#: Lines that name a holder or a year; licence texts themselves wrap before the word copyright.
_COPYRIGHT = r"(?im)^\P{L}*(?:copyright\b[\t :]*(?:\(c\)|©|\d{4}|by\b)|\(c\)[\t ]|©|all rights reserved\b)[^\n]*$"


#: A title above a licence text, which names it and is no part of it.
_TITLE = (
    r"(?i)^\s*(?:the\s+)?(?:(?:mit|isc|zlib)\s+licen[cs]e(?:\s+\((?:mit|isc)\))?|bsd\s+(?:[0-3]|zero)[- ]clause"
    r"(?:\s+\x22\w+\x22(?:\s+or\s+\x22\w+\x22)?)?\s+licen[cs]e)\s*\n(?=\s*\n)"
)


def canonical(text: Column) -> Column:
    """Lower case, copyright lines out, punctuation and space to single spaces, equivalent spellings to one."""
    plain = F.regexp_replace(text, F.lit(_COPYRIGHT), F.lit(" "))
    # Two spaces between words: each word keeps one on either side, also next to a word that was replaced.
    plain = F.concat(F.lit("  "), F.regexp_replace(F.lower(plain), F.lit(r"[^\p{L}\p{N}]+"), F.lit("  ")), F.lit("  "))
    for spelling, standard in EQUIVALENT:
        plain = F.replace(plain, F.lit(f" {spelling.replace(' ', '  ')} "), F.lit(f" {standard.replace(' ', '  ')} "))
    return F.trim(F.regexp_replace(plain, F.lit(" +"), F.lit(" ")))


def _start(text: Column) -> Column:
    """The first letters of a text, at most three: equivalent spellings share them."""
    return F.lower(F.regexp_extract(text, r"^[^\p{L}\p{N}]*([\p{L}\p{N}]{1,3})", 1))


def known_digests(licences: DataFrame) -> DataFrame:
    """One row per canonical digest, with the text's first letters and the sizes it has in paragraphs; of several licences
    with one text the first by name. Texts without words have none."""
    text = F.coalesce("text", F.lit(""))
    canon = licences.select(
        "licence", canonical(text).alias("canon"), F.size(_paragraphs(text)).alias("size")
    ).filter("canon != ''")
    return canon.groupBy(F.sha2("canon", 256).alias("digest"), _start(F.col("canon")).alias("start")).agg(
        F.min("licence").alias("licence"), F.collect_set("size").alias("sizes")
    )


def _paragraphs(text: Column) -> Column:
    """The paragraphs that have words besides copyright lines, without a title."""
    plain = F.regexp_replace(F.regexp_replace(text, F.lit(_COPYRIGHT), F.lit(" ")), F.lit(_TITLE), F.lit(" "))
    return F.filter(F.split(plain, r"\n[\x20\t\r]*\n", -1), lambda x: x.rlike(r"[\p{L}\p{N}]"))


def _runs(sizes: str) -> Column:
    """Of the column `paragraphs`, the runs of several that begin like a known licence and are as many as it has."""
    at = lambda x, i: F.transform(
        F.filter(
            F.coalesce(F.try_element_at(F.col(sizes), _start(x)), F.array().cast("array<int>")),
            lambda n: i + n <= F.size("paragraphs"),
        ),
        lambda n: F.array_join(F.slice("paragraphs", i + 1, n), "\n\n"),
    )
    return F.flatten(F.transform("paragraphs", at))


def known_licences(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(KNOWN), "licence string, text string")


def scan(docs: DataFrame, licences: DataFrame | None = None) -> DataFrame:
    """`doc_id`, `licence` whose text the whole text is (null: none), `notices`: the licences, sorted and comma-joined, whose
    whole text one of its paragraphs, lines or runs of paragraphs is (a title above the text aside), and `n_notices`, the number of different such parts.

    A null or empty text, and one of copyright lines alone, is no licence. Null ids stay, repeated rows give repeated
    results, an empty table gives an empty one, other columns are not read.

    A text and its parts are entire texts to look up. One whose first letters, copyright lines aside, begin no known licence
    is none, and is not normalised further; the others are, and their digests are joined to the known ones. What is found
    goes on by the digest of its document's text, so that copies collapse before the shuffle. Findings are joined without a
    hint: their measured size decides the kind of join, and no aggregate stands above it that would keep the planner from
    splitting a text that many rows share.
    """
    spark = docs.sparkSession
    known = known_digests(known_licences(spark) if licences is None else licences)
    if licences is None:
        long = spark.createDataFrame(list(DIGESTS), "digest string, start string, licence string, sizes array<int>")
        known = known.unionByName(long)
    known = cut(known)
    starts = cut(known.select("start").distinct())
    # Counted: a stored table has no size that the planner knows, and would have all parts shuffled to find none of them.
    starts = F.broadcast(starts) if starts.count() <= MAX_STARTS else starts
    several = known.select("start", F.explode("sizes").alias("size")).filter("size > 1").groupBy("start").agg(
        F.collect_set("size").alias("sizes")
    )
    # One row, of at most as many entries as there are starts.
    sizes = several.agg(F.map_from_entries(F.collect_list(F.struct("start", "sizes"))).alias("known_sizes"))
    known = known.drop("sizes")
    # Counted too: beside a handful of digests the parts stay where they are read, however often one of them stands there.
    known = F.broadcast(known) if known.count() <= MAX_STARTS else known
    read = texts(docs).withColumn("content", F.sha2("text", 256))
    paragraphs = F.split("text", r"\n[\x20\t\r]*\n", -1)
    blocks = F.transform(
        F.concat(F.array("text"), F.when(F.size(paragraphs) > 1, paragraphs).otherwise(F.array().cast("array<string>"))),
        lambda x: F.struct(F.regexp_replace(F.regexp_replace(x, F.lit(_COPYRIGHT), F.lit(" ")), F.lit(_TITLE), F.lit(" ")).alias("part"), (x == F.col("text")).alias("whole")),
    )
    lines = F.transform(F.split("text", r"\n", -1), lambda x: F.struct(x.alias("part"), (x == F.col("text")).alias("whole")))
    # The run of all paragraphs is the whole text, which is looked up as such.
    full = F.array_join("paragraphs", "\n\n")
    runs = F.transform(
        F.filter(_runs("known_sizes"), lambda x: x != full), lambda x: F.struct(x.alias("part"), F.lit(False).alias("whole"))
    )
    held = read.withColumn("paragraphs", _paragraphs(F.col("text"))).crossJoin(F.broadcast(sizes))
    parts = held.select("content", F.explode(F.concat(blocks, lines, runs)).alias("p")).select(
        "content", "p.*", _start(F.col("p.part")).alias("start")
    )
    likely = parts.join(starts, "start", "left_semi")
    found = likely.select("content", "whole", F.sha2(canonical(F.col("part")), 256).alias("digest")).join(known, "digest")
    once = found.groupBy("content", "digest").agg(
        F.min("licence").alias("licence"), F.max("whole").alias("whole"), F.max(~F.col("whole")).alias("inside")
    )
    by_content = cut(
        once.groupBy("content").agg(
            F.max(F.when(F.col("whole"), F.col("licence"))).alias("licence"),
            F.sort_array(F.collect_set(F.when(F.col("inside"), F.col("licence")))).alias("names"),
            F.sum(F.when(F.col("inside"), 1).otherwise(0)).alias("n"),
        )
    )
    return read.select("doc_id", "content").join(by_content, "content", "left").select(
        "doc_id",
        "licence",
        F.coalesce(F.array_join("names", ","), F.lit("")).alias("notices"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_notices"),
    )
