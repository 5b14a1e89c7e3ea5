"""License scan: whole texts and single lines by the digest of their canonical form. DataFrame functions only.

The canonical form is lower case, without the lines that state a copyright, with equivalent spellings made one, and with every run of
punctuation and white space as one space. A document whose canonical text is a known licence's gets its name; known one-line notices
are found among its lines in the same way. The known table is a constant of this module, so it is broadcast.

A null text has a null digest and no licence; an empty text has the digest of the empty string and no licence. Rows that repeat give
a row each. A null doc_id has its whole text looked up but no lines. An empty table gives an empty table; only doc_id and text are read.
"""

from __future__ import annotations

import pkgutil
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Equivalent spellings.
SPELLINGS = (
    ("licence", "license"), ("licenced", "licensed"), ("sublicence", "sublicense"), ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"), ("authorise", "authorize"), ("authorised", "authorized"), ("colour", "color"), ("favour", "favor"),
    ("fulfil", "fulfill"), ("initialise", "initialize"), ("merchantibility", "merchantability"), ("organisation", "organization"),
    ("recognise", "recognize"), ("whilst", "while"), ("wilful", "willful"), ("noninfringement", "non infringement"),
)

# Licence texts.
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""
def _whole(file: str, end: str) -> tuple[str, ...]:
    """A long text as published, and without what follows its terms (how to apply them)."""
    text = pkgutil.get_data(__package__, f"texts/{file}.txt").decode()
    return (text, text[:text.index(end)], text[:text.index(end) + len(end)]) if end else (text,)


_END = "END OF TERMS AND CONDITIONS"
_LONG = (("Apache-2.0", "Apache-2.0", _END), ("GPL-2.0", "GPL-2", _END), ("GPL-3.0", "GPL-3", _END), ("LGPL-2.1", "LGPL-2.1", _END),
         ("LGPL-3.0", "LGPL-3", ""), ("MPL-2.0", "MPL-2.0", ""))
TEXTS = (
    ("0BSD", _ISC.replace(", provided that the above copyright notice and this permission notice appear in all copies", "")),
    ("BSD-2-Clause", f"{_BSD_HEAD}\n\n{_BSD_TAIL}"), ("BSD-3-Clause", f"{_BSD_HEAD}\n\n{_BSD_NAMES}\n\n{_BSD_TAIL}"),
    ("ISC", _ISC), ("MIT", _MIT), ("MIT", f"MIT License\n\n{_MIT}"), ("MIT", f"The MIT License (MIT)\n\n{_MIT}"),
    ("ISC", f"ISC License\n\n{_ISC}"), ("Zlib", _ZLIB), ("Zlib", f"zlib License\n\n{_ZLIB}"),
    ("BSD-2-Clause", f"BSD 2-Clause License\n\n{_BSD_HEAD}\n\n{_BSD_TAIL}"),
    ("BSD-3-Clause", f"BSD 3-Clause License\n\n{_BSD_HEAD}\n\n{_BSD_NAMES}\n\n{_BSD_TAIL}"),
    *((name, text) for name, file, end in _LONG for text in _whole(file, end)),
)

# One-line notices, which are known texts of their own.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."), ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."), ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
)

# Patterns that Java and RE2 read alike.
def _other_than(words: tuple[str, ...], first: bool = True) -> str:
    """A pattern of how a word begins that is none of ``words`` in either case, spelt out as RE2 can't look ahead."""
    heads = {w[0] for w in words if w}
    letters = "".join(c + c.upper() for c in string.ascii_lowercase if c not in heads)
    no = "".join(c + c.upper() for c in sorted(heads))
    if first:
        found = [rf"[^{no} \t\r\n().,;:\x22]"]
    elif "" in words:
        found = [rf"[{letters}0-9\x{{80}}-\x{{10FFFF}}]"]
    else:
        found = [rf"[^{no}\n]", "$"]
    found += [f"[{c}{c.upper()}]" + _other_than(tuple(w[1:] for w in words if w[:1] == c), False) for c in sorted(heads)]
    return f"(?:{'|'.join(found)})"


# What follows "copyright" where a licence speaks of it; what else does, a year or a name, makes a statement.
_SPOKEN = (
    "also", "and", "applies", "are", "as", "attribution", "claim", "claims", "disclaimer", "disclaimers", "doctrine", "doctrines", "for", "from",
    "header", "headers", "holder", "holders", "if", "in", "information", "infringement", "interest", "interests", "is", "law", "laws", "legislation",
    "licence", "licences", "license", "licenses", "licensed", "line", "lines", "management", "may", "notice", "notices", "of", "on", "or", "owned",
    "owner", "owners", "ownership", "permission", "permissions", "protection", "right", "rights", "shall", "statement", "statements", "status",
    "subsists", "term", "terms", "that", "the", "to", "treaties", "treaty", "under", "which", "with",
)
_NAME = r"(?:[A-Z0-9<\[{\x22&\x{80}-\x{10FFFF}][^ \t\n]*|and|of|the|by|de|van|von|der|la|contributors|others|all|rights|reserved\.?)"
_SIGN = r"(?:\([cC]\)|©)"
# Lines that state a copyright: "copyright" with (c), a sign, a year or a name; (C) or a sign; (c), which may also count an
# item of a list, with a year or nothing but names; "all rights reserved" alone.
COPYRIGHT = (
    r"(?m)^[ \t*#/>-]*(?:"
    rf"(?i:copyright)(?:[ \t]*[,:]?[ \t]*{_SIGN}|[ \t]*[,:]?[ \t]*[0-9]|[ \t]*:?[ \t]+{_other_than(_SPOKEN)})[^\n]*"
    r"|(?:C|c)opyright[ \t]+The[ \t][^\n]*"
    r"|(?:\(C\)|©)[^\n]*"
    rf"|\(c\)[ \t]*(?:[0-9<\[©]|(?i:copyright))[^\n]*|\(c\)[ \t]*{_NAME}(?:[ \t]+{_NAME})*[ \t\r]*"
    r"|(?i:all[ \t]+rights[ \t]+reserved)[ \t\r.!*/#-]*"
    r")$")
MARKS = r"[^a-z0-9\x{80}-\x{10FFFF}]+"


def canonical(text: Column) -> Column:
    """Two spaces between words, so that each word has a space of its own on either side while spellings are replaced."""
    # Each kind of statement has one of these, and most texts and lines have none: they need not be searched by the long pattern.
    asked = F.lit(False)
    for part in ("copyright", "(c)", "©", "reserved"):
        asked = asked | F.contains(F.lower(text), F.lit(part))
    text = F.when(asked, F.regexp_replace(text, COPYRIGHT, "")).otherwise(text)
    plain = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), MARKS, "  ")), F.lit(" "))
    for spelling, same in SPELLINGS:
        plain = F.replace(plain, F.lit(f" {spelling} "), F.lit(f" {same} "))
    return F.replace(F.trim(plain), F.lit("  "), F.lit(" "))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known(spark: SparkSession, rows: tuple[tuple[str, str], ...]) -> DataFrame:
    """``(known, licence)``, each digest once."""
    table = spark.createDataFrame(list(rows), "licence string, text string")
    return table.groupBy(digest(F.col("text")).alias("known")).agg(F.min("licence").alias("licence"))


def scan(docs: DataFrame, texts: tuple[tuple[str, str], ...] = TEXTS + NOTICES, notices: tuple[tuple[str, str], ...] = NOTICES) -> DataFrame:
    """``(doc_id, digest, licence, notices)`` of each row: the licence that the whole text is, and those its lines name."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text")
    lines = rows.filter("doc_id is not null").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    named = (lines.select("doc_id", digest(F.col("line")).alias("known")).join(F.broadcast(known(spark, notices)), "known")
             .groupBy(F.col("doc_id").alias("doc_")).agg(F.array_sort(F.collect_set("licence")).alias("notices")))
    whole = rows.select("doc_id", digest(F.col("text")).alias("digest"))
    return (whole.join(F.broadcast(known(spark, texts)).withColumnRenamed("known", "digest"), "digest", "left")
            .join(named, F.col("doc_id") == F.col("doc_"), "left")
            .select("doc_id", "digest", "licence", F.coalesce("notices", F.array().cast("array<string>")).alias("notices")))
