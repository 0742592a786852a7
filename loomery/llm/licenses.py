"""Licence scan by canonical digest lookup, with built-in functions only.

A line is normalised: case, typographic signs, spellings that mean the same,
punctuation and white space; a line that only gives a copyright notice vanishes.
A text's normal form is that of its lines, joined. Digests of normal forms are
hash-joined to those of known texts, normalised by the very same expression. Two
sorts of entire text are looked up: the document, and each of its lines, since a
licence notice is one line.
"""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, functions as F

from loomery.llm.store import written

FOLDER = Path(__file__).parent / "known"
END = "END OF TERMS AND CONDITIONS"

# How licences are named in notices, by SPDX name.
NAMES = {
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache Software License 2.0"),
    "MIT": ("MIT License", "MIT/X11 License", "Expat License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License", "FreeBSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License"),
    "ISC": ("ISC License",),
    "Zlib": ("zlib License",),
    "MPL-1.1": ("Mozilla Public License, Version 1.1", "Mozilla Public License 1.1", "MPL 1.1"),
    "MPL-2.0": ("Mozilla Public License, Version 2.0", "Mozilla Public License 2.0", "MPL 2.0"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU General Public License v2.0", "GNU General Public License v2", "GNU GPL v2", "GPL v2", "GPLv2"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU General Public License v3.0", "GNU General Public License v3", "GNU GPL v3", "GPL v3", "GPLv3"),
    "LGPL-2.1": ("GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1", "GNU LGPL v2.1", "LGPL v2.1", "LGPLv2.1"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0", "GNU LGPL v3", "LGPL v3", "LGPLv3"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0", "GNU AGPL v3", "AGPL v3", "AGPLv3"),
    "Unlicense": ("Unlicense",),
    "CC0-1.0": ("CC0 1.0", "CC0 1.0 Universal", "Creative Commons Zero 1.0", "CC0 1.0 Universal Public Domain Dedication"),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-ND-4.0": ("CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License"),
    "CC-BY-NC-SA-4.0": ("CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    "CC-BY-NC-ND-4.0": ("CC BY-NC-ND 4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"),
}
# Wordings of notices; each is known with and without "the" before the name.
WORDINGS = (
    "Licensed under {}",
    "Licensed under the terms of {}",
    "Released under {}",
    "Released under the terms of {}",
    "Distributed under {}",
    "Distributed under the terms of {}",
    "Published under {}",
    "Available under {}",
    "Made available under {}",
    "Provided under {}",
    "This work is licensed under {}",
    "This project is licensed under {}",
    "This software is licensed under {}",
    "This program is licensed under {}",
    "This file is licensed under {}",
    "This code is licensed under {}",
    "This document is licensed under {}",
    "This work is released under {}",
    "This project is released under {}",
    "This software is released under {}",
    "This software is distributed under {}",
    "License: {}",
)
# Spellings that mean the same, after lower-casing.
SPELLINGS = (
    ("licence", "license"),
    ("licensor", "licenser"),
    ("noncommercial", "non commercial"),
    ("non-commercial", "non commercial"),
    ("sharealike", "share alike"),
    ("share-alike", "share alike"),
    ("non-infringement", "noninfringement"),
    ("acknowledgement", "acknowledgment"),
    ("organisation", "organization"),
    ("holder(s)", "holders"),
    ("http://", "https://"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A notice line: a copyright word or sign, then a sign, a year or a placeholder; wrapped body text has none there.
COPYRIGHT_LINE = r"\A[ \t*#/;]*(?:copyright[ \t:,]*(?:\(c\)|©|[0-9]{4}|[<\[{])|\(c\)[ \t]*(?:copyright|[0-9]{4}|[<\[{])|©)"
#: A run of ASCII punctuation, controls, blanks, and typographic quotes, dashes, dots and blanks becomes one space.
JOINED = r"[\x00-\x2F\x3A-\x60\x7B-\x7F\u00A0\u00AB\u00B7\u00BB\u2000-\u206F\u3000]+"


def _texts() -> list[tuple[str, str, str]]:
    """Texts kept as files: whole, without their title, and each also without what follows its terms."""
    out = []
    for path in sorted(FOLDER.glob("*.txt")):
        whole = path.read_text(encoding="utf-8").strip()
        bodies = (whole, whole.partition("\n\n")[2] or whole)
        cut = [b.partition(END)[0] + tail for b in bodies if END in b for tail in (END, "")]
        out += [(path.stem, "text", b) for b in dict.fromkeys((*bodies, *cut))]
    return out


def _notices() -> list[tuple[str, str, str]]:
    """Every wording with every name and SPDX name, and SPDX lines."""
    out = []
    for spdx, names in NAMES.items():
        for wording in WORDINGS:
            for name in (*names, spdx):
                out += [(spdx, "notice", wording.format(n)) for n in (name, f"the {name}")]
        out += [(spdx, "notice", f"SPDX-License-Identifier: {spdx}{more}") for more in ("", "-only", "-or-later")]
    return out


KNOWN = (*_texts(), *_notices())


def normal_line(line: Column) -> Column:
    """Normal form of one line, '' where nothing is left."""
    low = F.translate(line, UPPER, LOWER)
    out = low
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(old), F.lit(new))
    return F.when(low.rlike(COPYRIGHT_LINE), F.lit("")).otherwise(F.trim(F.regexp_replace(out, JOINED, " ")))


def _normal_lines(text: Column) -> Column:
    """Normal forms of the lines that leave any."""
    each = F.transform(F.split(F.coalesce(text, F.lit("")), r"\r\n|[\n\r]"), normal_line)
    return F.filter(each, lambda s: s != "")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def digest(normal: Column) -> Column:
    return F.unhex(F.sha2(normal, 256))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", known_texts: tuple[tuple[str, str, str], ...] = KNOWN) -> DataFrame:
    """One row per document: doc_id, text_digest, license, notices.

    license: known licence whose whole text the document is, null if none.
    notices: names of the notices that are lines of the document, distinct,
    sorted and comma-joined, '' if none. A null text counts as empty; an empty or blank
    one matches nothing. Repeated rows give repeated rows, a null id is kept, an empty
    table gives none; further columns are ignored. A very long text is split into its
    lines, and only 32 bytes a distinct line go on. ``known_texts``: rows of name,
    kind (text or notice) and body, a list of fixed length that is broadcast.
    """
    spark = docs.sparkSession
    known = spark.createDataFrame(list(known_texts), "name string, kind string, body string")
    normal = F.array_join(_normal_lines(F.col("body")), " ")
    table = written(known.select("kind", "name", digest(normal).alias("digest")).groupBy("kind", "digest").agg(F.min("name").alias("name")), "known")

    forms = _let(
        _normal_lines(F.col(text_col).cast("string")),
        lambda s: F.struct(digest(F.array_join(s, " ")).alias("text_digest"), F.array_distinct(F.transform(s, digest)).alias("line_digests")),
    )
    given = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), forms.alias("forms"))
    rows = written(given.select("row", "doc_id", "forms.*"), "digests")
    # the known texts are a list of fixed length: about 2,000 rows of 32 bytes and a name
    notices = F.broadcast(table.where("kind = 'notice'").select("digest", "name"))
    found = rows.select("row", F.explode("line_digests").alias("digest")).join(notices, "digest")
    names = found.groupBy("row").agg(F.array_join(F.array_sort(F.collect_set("name")), ",").alias("notices"))
    whole = F.broadcast(table.where("kind = 'text'").select(F.col("digest").alias("text_digest"), F.col("name").alias("license")))
    out = rows.select("row", "doc_id", "text_digest").join(whole, "text_digest", "left").join(names, "row", "left")
    return out.select("doc_id", F.lower(F.hex("text_digest")).alias("text_digest"), "license", F.coalesce("notices", F.lit("")).alias("notices"))
