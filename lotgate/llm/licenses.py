"""Licence scan by canonical digest lookup.

A text is brought to a canonical form: ASCII lower case, copyright statements
(lines of 'copyright' with (c), © or a year) dropped, equivalent spellings made
one, every run of marks (typographic ones too, so comment signs as well) and
white space one space. Texts with equal canonical forms have equal SHA-256 digests, so known
licences are found by a hash join on the digest of the *entire* text: no
pattern is searched for. The unit is the whole document, and each of its lines
(licence notices are lines of their own).

The table of known digests is made from the notices and texts below and the
whole texts in ``licence_texts`` by the same canonical form, with and without the
licence's title, 'All rights reserved' and the appendix after its terms, and in
each form that a wrapping of the lines can give; its size is fixed by them.
"""

from __future__ import annotations

import hashlib
import re
import textwrap
from functools import lru_cache
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import keep

# Public licence texts and notices, by SPDX identifier.
NOTICES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0."],
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License."],
    "GPL-3.0-only": ["This work is licensed under the GNU General Public License, version 3."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0."],
    "CC0-1.0": ["Licensed under CC0 1.0."],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License."],
    "MPL-2.0": ["Licensed under the Mozilla Public License, Version 2.0."],
}
TEXTS = {
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
}
# Titles that may stand before a text.
TITLES = {
    "ISC": ["ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)"],
    "MIT": ["MIT License", "The MIT License", "MIT License (MIT)", "The MIT License (MIT)"],
    "0BSD": ["BSD Zero Clause License", "Zero Clause BSD License", "Zero-Clause BSD", "0BSD License"],
    "Apache-2.0": ["Apache License Version 2.0, January 2004 http://www.apache.org/licenses/",
                   "Apache License Version 2.0, January 2004 https://www.apache.org/licenses/", "Apache License Version 2.0, January 2004"],
    "BSD-2-Clause": ["BSD 2-Clause License", "The BSD 2-Clause License", "BSD 2-Clause \"Simplified\" License", "Simplified BSD License", "BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "The BSD 3-Clause License", "BSD 3-Clause \"New\" or \"Revised\" License", "New BSD License", "BSD License"],
    "BSL-1.0": ["Boost Software License - Version 1.0 - August 17th, 2003"],
    "CC-BY-SA-4.0": ["Attribution-ShareAlike 4.0 International", "Creative Commons Attribution-ShareAlike 4.0 International"],
    "CC0-1.0": ["Creative Commons Legal Code CC0 1.0 Universal", "CC0 1.0 Universal"],
    "GFDL-1.2-only": ["GNU Free Documentation License Version 1.2, November 2002"],
    "GFDL-1.3-only": ["GNU Free Documentation License Version 1.3, 3 November 2008"],
    "GPL-1.0-only": ["GNU GENERAL PUBLIC LICENSE Version 1, February 1989"],
    "GPL-2.0-only": ["GNU GENERAL PUBLIC LICENSE Version 2, June 1991"],
    "GPL-3.0-only": ["GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "LGPL-2.0-only": ["GNU LIBRARY GENERAL PUBLIC LICENSE Version 2, June 1991"],
    "LGPL-2.1-only": ["GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"],
    "LGPL-3.0-only": ["GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "MPL-1.1": ["Mozilla Public License Version 1.1"],
    "MPL-2.0": ["Mozilla Public License Version 2.0"],
    "OFL-1.1": ["SIL OPEN FONT LICENSE Version 1.1 - 26 February 2007"],
    "Unlicense": ["The Unlicense", "Unlicense"],
    "Zlib": ["zlib License", "The zlib License", "The zlib/libpng License"],
}
RIGHTS = "All rights reserved."
WIDTHS = range(20, 141)
#: The terms end here; what follows says how to apply them.
END = "END OF TERMS AND CONDITIONS"
#: Texts whose clauses are numbered or not.
CLAUSES = ["BSD-2-Clause", "BSD-3-Clause", "Zlib"]
# Spellings taken as one.
SPELLINGS = [("licence", "license"), ("organisation", "organization"), ("authoris", "authoriz"), ("favour", "favor"),
             ("behaviour", "behavior"), ("colour", "color"), ("centre", "center"), ("fulfil ", "fulfill "), ("per cent", "percent"),
             ("copyright owner", "copyright holder"), ("non commercial", "noncommercial")]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TYPOGRAPHIC = ("\\u00A0\\u00A1\\u00A7\\u00AB\\u00B6\\u00B7\\u00BB\\u00BF\\u2000-\\u206F\\u3000-\\u3003\\u3008-\\u3011"
                "\\uFEFF\\uFF01-\\uFF0F\\uFF1A-\\uFF20")
_SIGNS = f"[\\x00-\\x09\\x0B\\x0C\\x0E-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F©{_TYPOGRAPHIC}]*"
#: A copyright statement; read by Java and Python alike.
STATEMENT = f"(?:copyright{_SIGNS}(?:\\(c\\)|©|[0-9]{{4}}|(?:year|yyyy|19xx|19yy)\\b)|\\(c\\){_SIGNS}[0-9]{{4}}|©)"
COPYRIGHT = f"(^|[\n\r]){_SIGNS}{STATEMENT}[^\n\r]*"
MARKS = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F©]+"
FOLDED = f"{MARKS[:-2]}{_TYPOGRAPHIC}]+"


def canonical(text: Column) -> Column:
    """The canonical form; null stays null."""
    out = F.regexp_replace(F.translate(text, _UPPER, _LOWER), COPYRIGHT, "\n")
    out = F.concat(F.lit(" "), F.regexp_replace(out, FOLDED, " "), F.lit(" "))
    for one, other in SPELLINGS:
        out = F.replace(out, F.lit(one), F.lit(other))
    return F.btrim(out)


def _folded(text: str) -> str:
    """:func:`canonical` in Python, but for the spellings."""
    out = re.sub(COPYRIGHT, "\n", text.translate(str.maketrans(_UPPER, _LOWER)))
    return re.sub(FOLDED, " ", out).strip(" ")


def canonical_text(text: str) -> str:
    """:func:`canonical` of a Python text."""
    return _spelled([_folded(text)])


def _spelled(pieces: list[str]) -> str:
    out = f" {' '.join(x for x in pieces if x)} "
    for one, other in SPELLINGS:
        out = out.replace(one, other)
    return out.strip(" ")


@lru_cache(None)
def _layouts(paragraph: str) -> list[str]:
    """The folded forms of a paragraph that holds a copyright statement: nothing
    dropped, as it stands, on one line, without the address of the publisher,
    and on lines of each of WIDTHS."""
    line = " ".join(paragraph.split())
    bare = re.sub(FOLDED, " ", line.translate(str.maketrans(_UPPER, _LOWER))).strip(" ")
    public = line.find("Everyone is permitted")
    return [bare, _folded(paragraph), _folded(line), _folded(line[public:]) if public > 0 else _folded(line),
            *(_folded(textwrap.fill(line, width)) for width in WIDTHS)]


def forms(text: str, titles: list[str] = ()) -> set[str]:
    """The canonical forms of a text, one for each way to write it: with a title
    or none, and with its paragraphs on lines of any width. A wrapping matters
    only where a copyright statement may come to begin a line."""
    paragraphs = [x.strip("\n") for x in re.split(r"\n[ \t\r]*\n", text) if x.strip()]
    own = re.match(COPYRIGHT, paragraphs[0].lower()) if paragraphs else None
    heads = {_folded(x) for title in ("", *titles) for x in (title, title if own else f"{title} {RIGHTS}")}
    moving = [i for i, x in enumerate(paragraphs) if re.search(STATEMENT, " ".join(x.lower().split()))]
    pieces = [_folded(x) for x in paragraphs]
    found = set()
    for layout in set(zip(*(_layouts(paragraphs[i]) for i in moving))) or {()}:
        for i, x in zip(moving, layout):
            pieces[i] = x
        found |= {_spelled([head, *pieces]) for head in heads}
    return found


def versions(spdx: str, text: str) -> set[str]:
    """A text with and without what comes after its terms, with either scheme in
    its links, with and without the numbers of its clauses."""
    found = {text}
    if END in text:
        terms = text[:text.index(END)]
        found |= {terms, terms + END}
    if spdx in CLAUSES:
        found |= {re.sub(r"(?m)^[ \t]*[0-9][.] ", "", x) for x in found}
    return found | {x.replace("https://", "http://") for x in found} | {x.replace("https://", "http://").replace("http://", "https://") for x in found}


def whole_texts() -> list[tuple[str, str]]:
    """(SPDX identifier, text) of the whole texts; a file's name is the
    identifier, and a number where a text has been published in several versions."""
    files = sorted((x.name, x.read_text("utf-8")) for x in (resources.files(__package__) / "licence_texts").iterdir() if x.name.endswith(".txt"))
    return [*TEXTS.items(), *((name[:-4].split("~")[0], text) for name, text in files)]


@lru_cache
def _known() -> list[tuple[str, str]]:
    rows = {(spdx, canonical_text(text)) for spdx, texts in NOTICES.items() for text in texts}
    rows |= {(spdx, form) for spdx, text in whole_texts() for version in versions(spdx, text) for form in forms(version, TITLES.get(spdx, []))}
    return sorted({(hashlib.sha256(form.encode()).hexdigest(), spdx) for spdx, form in rows})


def known_digests(spark: SparkSession) -> DataFrame:
    """(digest, licence) of the known texts, in canonical form."""
    return spark.createDataFrame(_known(), "digest string, licence string")


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(doc_id, digest, licence, n_licence_lines, line_licences) for each row
    of *docs* (doc_id, text): the digest of its canonical text, the licence
    that it is as a whole (else null), and the sorted licences that lines of it
    are (joined by a space; empty if none).

    A null text is empty, and an empty canonical form matches nothing. Rows
    with equal doc_id get the lines of all of them; a null doc_id has no line
    licences. An empty table gives no rows.
    """
    # The built-in table has a fixed size, so it is broadcast; a given one may be large.
    small = F.broadcast if known is None else (lambda frame: frame)
    known = known_digests(docs.sparkSession) if known is None else known
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.sha2(canonical(text), 256).alias("digest"))
    found = (docs.select("doc_id", F.explode(F.split(text, "\n", -1)).alias("line"))
             .select("doc_id", F.sha2(canonical(F.col("line")), 256).alias("digest")).join(small(known), "digest")
             .groupBy("doc_id").agg(F.count("*").alias("n_licence_lines"), F.array_join(F.sort_array(F.collect_set("licence")), " ").alias("line_licences")))
    found, _ = keep(found, "licence_lines")
    whole = known.withColumnRenamed("digest", "known_digest").groupBy("known_digest").agg(F.min("licence").alias("licence"))
    return (rows.join(small(whole), F.col("digest") == F.col("known_digest"), "left").drop("known_digest")
            .join(found, "doc_id", "left")
            .select("doc_id", "digest", "licence", F.coalesce("n_licence_lines", F.lit(0)).cast("long").alias("n_licence_lines"),
                    F.coalesce("line_licences", F.lit("")).alias("line_licences")))


def _re2(pattern: str) -> str:
    """A pattern above in the syntax of DuckDB."""
    return re.sub(r"\\u([0-9A-F]{4})", r"\\x{\1}", pattern)


def _sql_canonical(text: str) -> str:
    out = f"regexp_replace(translate({text}, '{_UPPER}', '{_LOWER}'), '{_re2(COPYRIGHT)}', chr(10), 'g')"
    out = f"(' ' || regexp_replace({out}, '{_re2(FOLDED)}', ' ', 'g') || ' ')"
    for one, other in SPELLINGS:
        out = f"replace({out}, '{one}', '{other}')"
    return f"trim({out})"


def oracle_sql() -> str:
    """DuckDB SQL for :func:`scan` over documents. The table of known digests
    is given to both; texts are brought to their canonical form here by
    DuckDB's own functions."""
    values = ", ".join(f"('{digest}', '{spdx}')" for digest, spdx in _known())
    return f"""
with k(digest, licence) as (values {values}),
d as (select doc_id, text, sha256({_sql_canonical('text')}) as digest from (select doc_id, coalesce(text, '') as text from documents)),
l as (select doc_id, sha256({_sql_canonical('line')}) as digest from (select doc_id, unnest(string_split(text, chr(10))) as line from d)),
f as (select doc_id, count(*) as n, string_agg(distinct licence, ' ' order by licence) as licences from l join k using (digest) group by doc_id),
w as (select digest, min(licence) as licence from k group by digest)
select d.doc_id, d.digest, w.licence, coalesce(f.n, 0)::bigint as n_licence_lines, coalesce(f.licences, '') as line_licences
from d left join w using (digest) left join f on d.doc_id = f.doc_id"""
