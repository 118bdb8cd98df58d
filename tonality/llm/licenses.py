"""License scan by canonical digest.

A text is brought to a canonical form - lower case, copyright lines out, every
run of punctuation and white space one space, equivalent spellings made one -
and its SHA-256 is hash-joined with the digests of known license texts and
notices.  The whole text is looked up, and each of its lines as a text of its
own, so that a notice inside a document is found as well.

Native expressions only.  The known texts are a fixed list (some thousand
rows), so their digests are broadcast; documents are not shuffled.

The full texts are the files of ``license_texts``.  Of the AGPL and of most
Creative Commons licenses only notices are known, and a notice that takes
several lines is found only where it is the whole text.

A null or empty text, or one of which nothing is left, matches nothing.
Repeated rows give repeated hits, null keys are kept; other columns are not
read.  An empty table gives no hits.
"""

from __future__ import annotations

import pkgutil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What names an owner (after lower-casing): from a symbol or year at the head of a line, after comment
# marks and a title, to the line's end or to license text on the same line.
COPYRIGHT_LINE = (
    r"(?m)^[^\p{L}\p{N}\n(©]*(?:(?:dnl|rem)[ \t]+)?"
    r"(?:(?:the )?(?:mit|isc) license(?: \((?:mit|isc)\))?[^\p{L}\p{N}\n(©]*(?=copyright|\(c\)|©))?"
    r"(?:(?:copyright|copr\.)[ \t:,]*(?:\(c\)|©|&copy;|[\[<{(]?(?:\d{4}|yyyy|year)\b"
    r"|the [^\n]*(?:authors|contributors|developers)[ \t.]*$)|©|&copy;|\(c\)[ \t]*(?:copyright|\d{4})|all rights reserved[ \t.]*$)"
    r"[^\n]*?(?=$|\b(?:permission is hereby granted|permission to use|redistribution and use|(?:licensed|released|distributed)"
    r" under|this (?:software|program|library|file|work|document|source code) |everyone is permitted|spdx-license-identifier))")
#: of ``scan_sql``: any line that begins like one
SQL_COPYRIGHT_LINE = r"(?m)^[ \t]*(?:copyright|\(c\)|©|all rights reserved)[^\n]*$"
# Spellings that license texts use for one another, as they stand between spaces.
SAME_SPELLING = (
    ("licenc", "licens"), ("sub licens", "sublicens"), ("non commercial", "noncommercial"),
    ("organis", "organiz"), ("favour", "favor"), ("honour", "honor"), ("judgement", "judgment"),
    ("acknowledgement", "acknowledgment"), ("whilst", "while"), ("per cent", "percent"),
    ("copyright owner", "copyright holder"), ("https ", "http "),
)

_AS_IS = ('The software is provided "as is", without warranty of any kind, express or implied, including but not '
          "limited to the warranties of merchantability, fitness for a particular purpose and noninfringement. In no "
          "event shall the authors or copyright holders be liable for any claim, damages or other liability, whether "
          "in an action of contract, tort or otherwise, arising from, out of or in connection with the software or "
          "the use or other dealings in the software.")
_ISC_GRANT = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
              "is hereby granted")
_ISC_AS_IS = ('The software is provided "as is" and the author disclaims all warranties with regard to this software '
              "including all implied warranties of merchantability and fitness. In no event shall the author be "
              "liable for any special, direct, indirect, or consequential damages or any damages whatsoever "
              "resulting from loss of use, data or profits, whether in an action of contract, negligence or other "
              "tortious action, arising out of or in connection with the use or performance of this software.")
_BSD_GRANT = ("Redistribution and use in source and binary forms, with or without modification, are permitted "
              "provided that the following conditions are met: ")
_BSD_1 = ("1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
          "following disclaimer. ")
_BSD_2 = ("2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
          "the following disclaimer in the documentation and/or other materials provided with the distribution. ")
_BSD_3 = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
          "promote products derived from this software without specific prior written permission. ")
_BSD_AS_IS = ('This software is provided by the copyright holders and contributors "as is" and any express or implied '
              "warranties, including, but not limited to, the implied warranties of merchantability and fitness for a "
              "particular purpose are disclaimed. In no event shall the copyright holder or contributors be liable "
              "for any direct, indirect, incidental, special, exemplary, or consequential damages (including, but not "
              "limited to, procurement of substitute goods or services; loss of use, data, or profits; or business "
              "interruption) however caused and on any theory of liability, whether in contract, strict liability, "
              "or tort (including negligence or otherwise) arising in any way out of the use of this software, even "
              "if advised of the possibility of such damage.")
_MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software. ")
_ZLIB = ("This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
         "held liable for any damages arising from the use of this software. Permission is granted to anyone to use "
         "this software for any purpose, including commercial applications, and to alter it and redistribute it "
         "freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; "
         "you must not claim that you wrote the original software. If you use this software in a product, an "
         "acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source "
         "versions must be plainly marked as such, and must not be misrepresented as being the original software. "
         "3. This notice may not be removed or altered from any source distribution.")
_APACHE_NOTICE = ('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
                  "compliance with the License. You may obtain a copy of the License at "
                  "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
                  'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
                  "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
                  "language governing permissions and limitations under the License.")
# Public license texts and full notices.
TEXTS = (
    ("MIT", _MIT + _AS_IS), ("MIT", "The MIT License\n" + _MIT + _AS_IS), ("MIT", "MIT License\n" + _MIT + _AS_IS),
    ("MIT", "The MIT License (MIT)\n" + _MIT + _AS_IS),
    ("ISC", _ISC_GRANT + ", provided that the above copyright notice and this permission notice appear in all copies. "
     + _ISC_AS_IS),
    ("0BSD", _ISC_GRANT + ". " + _ISC_AS_IS),
    ("BSD-2-Clause", _BSD_GRANT + _BSD_1 + _BSD_2 + _BSD_AS_IS),
    ("BSD-3-Clause", _BSD_GRANT + _BSD_1 + _BSD_2 + _BSD_3 + _BSD_AS_IS),
    ("Zlib", _ZLIB),
    ("Apache-2.0", _APACHE_NOTICE),
)


# The files of license_texts, and where each text may end early (its appendix is often left out).
FULL_TEXTS = (("Apache-2.0", "APPENDIX: How to apply"), ("CC-BY-SA-4.0", None), ("CC0-1.0", None),
              ("GPL-1.0", "Appendix: How to Apply"), ("GPL-2.0", "How to Apply These Terms to Your New"),
              ("GPL-3.0", "How to Apply These Terms to Your New"), ("LGPL-2.0", "How to Apply These Terms to Your New"),
              ("LGPL-2.1", "How to Apply These Terms to Your New"), ("LGPL-3.0", None), ("MPL-1.1", "EXHIBIT A"),
              ("MPL-2.0", "Exhibit A - Source Code Form"), ("Unlicense", None))
_MPL_NOTICE = ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
               "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.")
_INCOMPATIBLE = ' This Source Code Form is "Incompatible With Secondary Licenses", as defined by the Mozilla Public License, v. 2.0.'


def _full_texts() -> list[tuple[str, str]]:
    """Each full text as it stands and in one line, with and without its appendix."""
    out = []
    for tag, appendix in FULL_TEXTS:
        text = pkgutil.get_data(__package__, f"license_texts/{tag}.txt").decode("utf-8")
        cut = text.rfind(appendix) if appendix else -1
        for t in [text] + ([text[:cut]] if cut > 0 else []):
            out += [(tag, t), (tag, " ".join(t.split()))]
    return out


def _gnu_notices() -> list[tuple[str, str]]:
    """The usual notices of several lines: "This program is free software ..."."""
    ends = ["If not, see <http://www.gnu.org/licenses/>", "If not, see <http://gnu.org/licenses/>"]
    ends += [f"if not, write to the Free Software Foundation, Inc., {street}, {city}{usa}" for usa in ("", " USA") for street, city in (
        ("51 Franklin Street, Fifth Floor", "Boston, MA 02110-1301"), ("51 Franklin St, Fifth Floor", "Boston, MA 02110-1301"),
        ("59 Temple Place, Suite 330", "Boston, MA 02111-1307"), ("59 Temple Place - Suite 330", "Boston, MA 02111-1307"),
        ("675 Mass Ave", "Cambridge, MA 02139"))]
    out = []
    for tag, name, versions in (("GPL", "General", ("2", "3")), ("LGPL", "Lesser General", ("2", "2.1", "3")),
                                ("LGPL", "Library General", ("2",)), ("AGPL", "Affero General", ("3",))):
        name = f"GNU {name} Public License"
        for v in versions:
            for what in ("program", "library", "software", "file"):
                for later in (f"either version {v} of the License, or (at your option) any later version",
                              f"version {v} of the License", f"version {v}"):
                    head = (f"This {what} is free software; you can redistribute it and/or modify it under the terms of the {name} "
                            f"as published by the Free Software Foundation; {later}. This {what} is distributed in the hope that "
                            "it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
                            f"FITNESS FOR A PARTICULAR PURPOSE. See the {name} for more details.")
                    got = f" You should have received a copy of the {name} along with this {what}"
                    out += [(v if "." in v else v + ".0", t) for t in (head, *[f"{head}{got}; {end}." for end in ends])]
                    out[-len(ends) - 1:] = [(f"{tag}-{n}", t) for n, t in out[-len(ends) - 1:]]
    return out


def _notices() -> list[tuple[str, str]]:
    """One-line notices: each usual wording with each license name."""
    named = [("MIT", "the MIT License"), ("ISC", "the ISC License"), ("Unlicense", "the Unlicense"),
             ("BSD-2-Clause", "the BSD 2-Clause License"), ("BSD-3-Clause", "the BSD 3-Clause License"),
             ("Apache-2.0", "the Apache License, Version 2.0"), ("Apache-2.0", "the Apache License 2.0"),
             ("MPL-2.0", "the Mozilla Public License, Version 2.0"), ("MPL-2.0", "the Mozilla Public License 2.0")]
    for tag, name, versions in (("GPL", "GNU General Public License", (2, 3)),
                                ("LGPL", "GNU Lesser General Public License", (2, 3)),
                                ("AGPL", "GNU Affero General Public License", (3,))):
        named += [(f"{tag}-{v}.0", f"the {name}{how}{v}{dot}") for v in versions
                  for how in (", version ", " version ", " v") for dot in ("", ".0")]
    for parts in ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND"):
        named += [(f"CC-{parts}-{v}", f"CC {parts} {v}") for v in ("2.0", "3.0", "4.0")]
    named.append(("CC0-1.0", "CC0 1.0"))
    how = ("Licensed under ", "Released under ", "Distributed under ", "This work is licensed under ",
           "This document is licensed under ", "This software is licensed under ")
    return [(tag, h + name) for tag, name in named for h in how] \
        + [(tag, f"SPDX-License-Identifier: {tag}") for tag in dict.fromkeys(t for t, _ in named)]


def known_texts() -> list[tuple[str, str]]:
    """``(license_id, text)`` of everything that is looked up."""
    return [*_sql_texts(), *_full_texts(), *_gnu_notices(), ("MPL-2.0", _MPL_NOTICE), ("MPL-2.0", _MPL_NOTICE + _INCOMPATIBLE)]


def _sql_texts() -> list[tuple[str, str]]:
    return [*TEXTS, *_notices()]


def canonical(text: Column) -> Column:
    """The canonical form; empty where nothing is left."""
    out = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "")
    out = F.concat(F.lit(" "), F.trim(F.regexp_replace(out, r"[^\p{L}\p{N}]+", " ")), F.lit(" "))
    for old, new in SAME_SPELLING:
        out = F.replace(out, F.lit(" " + old), F.lit(" " + new))
    return F.trim(out)


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_digests(spark: SparkSession) -> DataFrame:
    """``(digest, license_id)``, one row a digest."""
    rows = spark.createDataFrame(known_texts(), "license_id string, text string")
    return rows.groupBy(digest(F.col("text")).alias("digest")).agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(key, unit, line_no, license_id, digest)``: every whole text and every line that is a known text.

    ``unit`` is ``text`` (``line_no`` 0) or ``line`` (numbered from 1).
    """
    units = docs.select(
        F.col(f"`{key}`"),
        F.posexplode(F.concat(F.array(F.col(f"`{text}`")), F.split(F.col(f"`{text}`"), "\n"))).alias("line_no", "unit_text"))
    known = known_digests(docs.sparkSession)
    hits = units.withColumn("digest", digest(F.col("unit_text"))).join(F.broadcast(known), "digest")
    return hits.select(F.col(f"`{key}`"), F.when(F.col("line_no") == 0, "text").otherwise("line").alias("unit"),
                       F.col("line_no").cast("long"), "license_id", "digest")


def _sql_canonical(col: str) -> str:
    line = SQL_COPYRIGHT_LINE.replace("'", "''")
    out = f"regexp_replace(lower({col}), '{line}', '', 'g')"
    out = f"' ' || trim(regexp_replace({out}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) || ' '"
    for old, new in SAME_SPELLING:
        out = f"replace({out}, ' {old}', ' {new}')"
    return f"trim({out})"


def scan_sql() -> str:
    """The scan over the view ``documents`` without the full texts and notices of several lines, whole copyright lines out."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    values = ", ".join(f"({quote(i)}, {quote(t)})" for i, t in _sql_texts())
    return f"""
        WITH known AS (SELECT sha256({_sql_canonical('text')}) AS digest, min(license_id) AS license_id
                       FROM (VALUES {values}) AS t(license_id, text) GROUP BY 1),
        units AS (SELECT doc_id, 'text' AS unit, 0 AS line_no, text AS unit_text FROM documents
                  UNION ALL
                  SELECT doc_id, 'line', unnest(range(1, len(string_split(text, chr(10))) + 1)),
                         unnest(string_split(text, chr(10))) FROM documents)
        SELECT doc_id, unit, CAST(line_no AS BIGINT) AS line_no, license_id, known.digest
        FROM units JOIN known ON sha256({_sql_canonical('unit_text')}) = known.digest"""
