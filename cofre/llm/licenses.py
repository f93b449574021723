"""License scans by canonical digest.

A text is brought into canonical form: titles and copyright lines go, case and punctuation are levelled, equivalent spellings
become one. Its SHA-256 is then joined with the digests of known texts, of which the long standard ones are kept as digests alone. Both the whole text of a document and each
of its lines are looked up as entire texts: the former finds licence files, the latter one-line notices.

Defined results: null, empty and unknown texts give no row; a text or line found several times in a document gives
one row with the count; a document found under several licences gives a row for each. A null key is kept. Rows with
a repeated key are counted together. Texts of any length are read whole. An empty table gives no rows. Other columns, whatever their names, are
not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cofre.llm.common import join_few

# Equivalent spellings, after the public matching guidelines for licence texts.
SPELLINGS = {
    "acknowledgement": "acknowledgment",
    "analog": "analogue",
    "authorisation": "authorization",
    "behaviour": "behavior",
    "cancelled": "canceled",
    "centre": "center",
    "colour": "color",
    "favour": "favor",
    "fulfil": "fulfill",
    "licence": "license",
    "licenced": "licensed",
    "noncommercial": "non commercial",
    "organisation": "organization",
    "recognise": "recognize",
    "sublicence": "sublicense",
    "version": "v",
    "wilful": "willful",
    "©": "copyright",
}

# Known licence texts and notices.
KNOWN = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\");"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN
AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
)

_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following
disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
%s
"""
_BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.
"""
_BSD_WARRANTY = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
KNOWN = (
    *KNOWN,
    ("BSD-2-Clause", _BSD % "" + _BSD_WARRANTY),
    ("BSD-3-Clause", _BSD % _BSD_THIRD + _BSD_WARRANTY),
)

# Digests of the canonical form of standard licence texts.
KNOWN_DIGESTS = (
    ("Apache-2.0", "542fc16faea327aebc65fbf3b3a98f77cf03dd473fcdee56bfd3dc3a713b4879"),
    ("Artistic-1.0-Perl", "bf23927f03247105fc05c98b8488b0b7c191765df471dfe8d9c08fb8b39c88e1"),
    ("CC0-1.0", "c3072adeaa8155c2568fc8440f68b84f17c40309e556fb82b03e4264e83f88f4"),
    ("GFDL-1.2", "e0a7059a5dc97f2191964b5282bc7a1ba964b179df8205b5f68ceebc40a2673d"),
    ("GFDL-1.3", "e40d391d82391d0e0264d2daec65cce1828bb891da8ce16bdb58243c9d5762f4"),
    ("GPL-1.0", "36954be8e4bd454ea3e0b65237c9ace86e89a63e4ca1ca0d0d75ce351e44d1d9"),
    ("GPL-2.0", "f1fec8461b48d423806de32223ed907570224025b2a0708f62f9e19d06f950f4"),
    ("GPL-3.0", "50185336f1c36a4066118f6bf3c2bcceaecb70f40d1084f7ce539c395e88b882"),
    ("LGPL-2.0", "3706d6afd219bfa13614d34ecfe3b57304102e4bca04844fe5348f472d5e9c27"),
    ("LGPL-2.1", "81173c433ccdd3de489db097958da875d7d5782f764a2d421b169c6e684a94cf"),
    ("LGPL-3.0", "505ecfefb80eb1b65ce90874e42d89f2eef8f1cf5facf90872cf78be6ddad571"),
    ("MPL-1.1", "d4a9e478678fa47e3317777f8fab0ac3b41a85b3d07ec2f386a912ab018db4e0"),
    ("MPL-2.0", "82b6788c25fce60ad5ecc80e5fe312e33ff5331f2f335b0f7546a8289077db2a"),
)

# Lines that are a licence's title, in canonical form.
TITLES = (
    "mit license", "the mit license", "the mit license mit", "mit license mit", "expat license", "isc license", "the isc license", "isc license isc",
    "bsd 2 clause license", "bsd 3 clause license", "the 2 clause bsd license", "the 3 clause bsd license", "simplified bsd license",
    "bsd 2 clause simplified license", "bsd 3 clause new or revised license", "new bsd license", "modified bsd license", "license",
    "license agreement", "the license",
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PUNCTUATION = "[^a-z0-9©\u0080-￿]+"
#: A line of its own that names a holder: "Copyright (c) 2020 Name", "(c) Name", "Copyright Name 2020", "Copyright [yyyy] [name]".
COPYRIGHT_LINE = "^[^a-z0-9©(]*((copyright|©|\\(c\\)).*([0-9]{4}|\\(c\\)|©|yyyy|<year>).*|© .*|all rights reserved[^a-z0-9]*)$"
#: The number or letter of a list item.
ITEM_NUMBER = "^[^a-z0-9]*([0-9]{1,2}|[a-z])[.)] +"
#: Whether a levelled line has a word with another spelling.
SPELLED = f"(^| )({'|'.join(SPELLINGS)})( |$)"


def _levelled(line: Column) -> Column:
    """A plain line with its spellings levelled."""

    def spelling(word: Column) -> Column:
        found = word
        for old, new in SPELLINGS.items():
            found = F.when(word == old, new).otherwise(found)
        return found

    return F.when(F.regexp_like(line, F.lit(SPELLED)), F.array_join(F.transform(F.split(line, " "), spelling), " ")).otherwise(line)


def canonical_lines(text: Column) -> Column:
    """The lines that are left of a text, as an array: lower case, words parted by one space, no item numbers, spellings levelled;
    titles, copyright lines and lines without words go. One step after the other, so that each is computed once a line."""
    lines = F.split(F.replace(F.coalesce(text, F.lit("")), F.lit("\r"), F.lit("")), "\n")
    lower = F.transform(lines, lambda line: F.translate(line, UPPER, LOWER))
    nameless = F.filter(lower, lambda line: ~F.regexp_like(line, F.lit(COPYRIGHT_LINE)))
    plain = F.transform(nameless, lambda line: F.btrim(F.regexp_replace(F.regexp_replace(line, ITEM_NUMBER, ""), PUNCTUATION, " ")))
    return F.transform(F.filter(plain, lambda line: ~line.isin("", *TITLES)), _levelled)


def digests_of(texts: DataFrame) -> DataFrame:
    """license_id, digest: a row for each distinct text of ``texts`` (license_id, text), so that a table of any licences can be looked up."""
    return texts.select("license_id", F.sha2(F.array_join(canonical_lines(F.col("text")), " "), 256).alias("digest")).distinct()


def known_digests(spark: SparkSession) -> DataFrame:
    """license_id, digest of the texts that are known here."""
    texts = spark.createDataFrame(list(KNOWN), "license_id string, text string")
    return digests_of(texts).union(spark.createDataFrame(list(KNOWN_DIGESTS), "license_id string, digest string")).distinct()


def scan_licenses(df: DataFrame, text: str = "text", key: str = "doc_id", known: DataFrame | None = None) -> DataFrame:
    """key, license_id, scope (text or line), n_found. ``known``: other digests than those known here, see :func:`digests_of`."""
    lines = df.select(F.col(key).alias("key"), canonical_lines(F.col(text)).alias("lines")).where(F.size("lines") > 0)
    entire = F.struct(F.lit("text").alias("scope"), F.array_join("lines", " ").alias("form"))
    each = F.transform("lines", lambda line: F.struct(F.lit("line").alias("scope"), line.alias("form")))
    forms = lines.select("key", F.explode(F.concat(F.array(entire), each)).alias("x")).select(
        "key", "x.scope", F.sha2("x.form", 256).alias("digest")
    )
    known = known_digests(df.sparkSession) if known is None else known
    sought = known.select("license_id", F.col("digest").alias("k_digest")).distinct()
    found = join_few(forms, sought, [(F.col("digest"), "k_digest")])
    return found.groupBy("key", "license_id", "scope").agg(F.count(F.lit(1)).alias("n_found"))
