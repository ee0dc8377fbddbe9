"""Licence texts by the digest of their canonical form.

Texts are brought to one canonical form: lower case, no copyright lines, one spelling of
each word that licences spell in two ways, no punctuation, single blanks. A document is
a known licence if its whole canonical text has the digest of one. All of it is
DataFrame functions; the digests of the known texts are a small table of fixed size.
"""

from __future__ import annotations

from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spellings that count as equal, as the guidelines for matching licences
# list them (the first of each pair becomes the second).
SPELLINGS = [
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("analyse", "analyze"),
    ("artefact", "artifact"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("calibre", "caliber"),
    ("cancelled", "canceled"),
    ("capitalisations", "capitalizations"),
    ("catalogue", "catalog"),
    ("categorise", "categorize"),
    ("centre", "center"),
    ("emphasised", "emphasized"),
    ("favour", "favor"),
    ("favourite", "favorite"),
    ("fulfil", "fulfill"),
    ("fulfilment", "fulfillment"),
    ("initialise", "initialize"),
    ("judgement", "judgment"),
    ("labelling", "labeling"),
    ("labour", "labor"),
    ("licence", "license"),
    ("maximise", "maximize"),
    ("modelled", "modeled"),
    ("modelling", "modeling"),
    ("offence", "offense"),
    ("optimise", "optimize"),
    ("organisation", "organization"),
    ("organise", "organize"),
    ("practise", "practice"),
    ("programme", "program"),
    ("realise", "realize"),
    ("recognise", "recognize"),
    ("signalling", "signaling"),
    ("utilisation", "utilization"),
    ("whilst", "while"),
    ("wilful", "willful"),
]

# Known texts, as published.
KNOWN = {
    "MIT": """
        Permission is hereby granted, free of charge, to any person obtaining a copy of this
        software and associated documentation files (the "Software"), to deal in the Software
        without restriction, including without limitation the rights to use, copy, modify, merge,
        publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons
        to whom the Software is furnished to do so, subject to the following conditions:

        The above copyright notice and this permission notice shall be included in all copies or
        substantial portions of the Software.

        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,
        INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR
        PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE
        FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
        OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
        DEALINGS IN THE SOFTWARE.
    """,
    "ISC": """
        Permission to use, copy, modify, and/or distribute this software for any purpose with or
        without fee is hereby granted, provided that the above copyright notice and this permission
        notice appear in all copies.

        THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO
        THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT
        SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR
        ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
        CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE
        OR PERFORMANCE OF THIS SOFTWARE.
    """,
    "0BSD": """
        Permission to use, copy, modify, and/or distribute this software for any purpose with or
        without fee is hereby granted.

        THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO
        THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT
        SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR
        ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF
        CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE
        OR PERFORMANCE OF THIS SOFTWARE.
    """,
    "BSD-2-Clause": """
        Redistribution and use in source and binary forms, with or without modification, are
        permitted provided that the following conditions are met:

        1. Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer.

        2. Redistributions in binary form must reproduce the above copyright notice, this list of
        conditions and the following disclaimer in the documentation and/or other materials
        provided with the distribution.

        THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS
        OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
        MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE
        COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
        EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF
        SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
        HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
        TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE,
        EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
    """,
    "Zlib": """
        This software is provided 'as-is', without any express or implied warranty. In no event
        will the authors be held liable for any damages arising from the use of this software.

        Permission is granted to anyone to use this software for any purpose, including commercial
        applications, and to alter it and redistribute it freely, subject to the following
        restrictions:

        1. The origin of this software must not be misrepresented; you must not claim that you
        wrote the original software. If you use this software in a product, an acknowledgment in
        the product documentation would be appreciated but is not required.

        2. Altered source versions must be plainly marked as such, and must not be misrepresented
        as being the original software.

        3. This notice may not be removed or altered from any source distribution.
    """,
    "Apache-2.0 notice": """
        Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
        except in compliance with the License. You may obtain a copy of the License at

        http://www.apache.org/licenses/LICENSE-2.0

        Unless required by applicable law or agreed to in writing, software distributed under the
        License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
        either express or implied. See the License for the specific language governing permissions
        and limitations under the License.
    """,
}
KNOWN["BSD-3-Clause"] = KNOWN["BSD-2-Clause"].replace("THIS SOFTWARE IS PROVIDED", """3. Neither the name of
        the copyright holder nor the names of its contributors may be used to endorse or promote
        products derived from this software without specific prior written permission.

        THIS SOFTWARE IS PROVIDED""")

# Title lines that files put before texts which have none of their own.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The 2-Clause BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The 3-Clause BSD License"),
    "Zlib": ("zlib License", "The zlib License"),
}
#: Whole texts often come without the appendix that follows this line.
END = "END OF TERMS AND CONDITIONS"


def _registered() -> dict[str, str]:
    """All texts by name: those above, these with a title line, and the files of whole texts."""
    texts = dict(KNOWN)
    for name, titles in TITLES.items():
        texts |= {f"{name}, titled {title}": f"{title}\n\n{KNOWN[name]}" for title in titles}
    for file in sorted(resources.files(__package__).joinpath("licence_texts").iterdir(), key=lambda f: f.name):
        name, text = file.name.removesuffix(".txt"), file.read_text("utf-8")
        texts[name] = text
        if END in text:
            texts[f"{name} without appendix"] = text[: text.index(END) + len(END)]
    return texts


KNOWN = _registered()

#: Java and DuckDB read these alike. A line is a copyright line if it begins, after blanks
#: and marks of a comment, with the word and a sign or year, or with the sign.
COPYRIGHT_LINE = (
    r"(^|\n)[ \t/*#;.-]*(copyright[ \t:]+(\(c\)|©|[0-9]|by )|\(c\)[ \t]+[0-9]|©|all rights reserved)[^\n]*"
)
OTHER = r"[^a-z0-9\x{80}-\x{10FFFF}]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def canonical(text: Column) -> Column:
    """The canonical form of a text; null text is empty. Lower-casing is of A-Z.

    Copyright lines go first, then everything but letters, digits and characters beyond
    ASCII turns into blanks, and equivalent spellings become one. Two blanks lie between
    words meanwhile, so that each word has a pair of its own.
    """
    lower = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    plain = F.regexp_replace(lower, COPYRIGHT_LINE, "\n")
    form = F.concat(F.lit(" "), F.regexp_replace(plain, OTHER, "  "), F.lit(" "))
    for old, new in SPELLINGS:
        form = F.replace(form, F.lit(f" {old} "), F.lit(f" {new} "))
    return F.trim(F.replace(form, F.lit("  "), F.lit(" ")))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text).cast("binary"), 256)


def known_digests(spark: SparkSession, known: dict[str, str] | None = None) -> DataFrame:
    """(licence, digest): one row per canonical text, the first name of those that share it."""
    texts = F.array(*[
        F.struct(F.lit(name).alias("licence"), F.lit(text).alias("known"))
        for name, text in (KNOWN if known is None else known).items()
    ])
    rows = spark.range(1).select(F.inline(texts)) if known is None or known else spark.range(0).select(
        F.lit("").alias("licence"), F.lit("").alias("known")
    )
    return rows.select("licence", digest(F.col("known")).alias("digest")).groupBy("digest").agg(
        F.min("licence").alias("licence")
    )


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(doc_id, canonical_sha256, licence) for every row of ``docs``; null where none is known.

    Null and empty texts, and those of copyright lines and punctuation alone, have the
    digest of the empty text and no licence. Rows are independent of each other: repeated
    ones and those with a null id are looked up like any other. With no known licences
    nothing matches.
    """
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), digest(docs["text"]).alias("canonical_sha256"))
    known = known.select(F.col("digest").alias("_digest"), "licence").where(F.col("digest") != F.sha2(F.lit(b""), 256))
    return rows.join(known, F.col("canonical_sha256") == F.col("_digest"), "left").select(
        "doc_id", "canonical_sha256", "licence"
    )


def oracle_sql() -> str:
    """The scan of ``documents`` for DuckDB."""
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    form = f"""'  ' || regexp_replace(regexp_replace(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
        {quoted(COPYRIGHT_LINE)}, chr(10), 'g'), {quoted(OTHER)}, '  ', 'g') || '  '"""
    for old, new in SPELLINGS:
        form = f"replace({form}, ' {old} ', ' {new} ')"
    form = f"sha256(trim(replace({form}, '  ', ' ')))"
    known = ", ".join(f"({quoted(name)}, {quoted(text)})" for name, text in KNOWN.items())
    return f"""
        WITH known AS (
            SELECT {form} AS digest, min(licence) AS licence
            FROM (VALUES {known}) AS k(licence, text) GROUP BY 1
        ), d AS (
            SELECT doc_id, {form} AS canonical_sha256 FROM documents
        )
        SELECT doc_id, canonical_sha256, licence
        FROM d LEFT JOIN known ON canonical_sha256 = digest AND digest <> sha256('')
    """
