"""License scans: canonical digest lookup in DataFrame functions alone.

A text is brought to a canonical form, in one pass: A-Z in lower case, ASCII punctuation (with it
comment signs) and runs of blanks as one blank, statements of copyright cut out, equivalent spellings
made one. A statement of copyright is a line that begins as one, up to the words of a notice on the same
line. The digest of the whole canonical text is joined to the digests of known licences; the digests of
single lines are looked up too, to find known one-line notices within longer documents. Lines whose
length no known notice has are not looked up.

The known table is fixed: whole texts of the licences in KNOWN and WHOLE and the notices in KNOWN, a few
dozen digests; that bounds what is broadcast and held in the plan. A table given by the caller is joined
as large as it is, by the content of the lines.

Defined results. A null text is empty; an empty canonical text has the digest of the empty string and
matches nothing. Each row stands alone: neither doc_id nor its absence matters. Repeated rows get the
same result.
"""

from __future__ import annotations

import hashlib
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: ASCII but for letters, digits and line feeds.
PUNCTUATION = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"
#: Spellings that count as one, applied in this order.
EQUIVALENT = [("licence", "license"), ("licencing", "licensing"), ("sub license", "sublicense"), ("non commercial", "noncommercial"), ("organisation", "organization"), ("favour", "favor"), ("http www", "https www"), ("copyright holder s", "copyright holders"), ("whilst", "while"), ("cannot", "can not"), ("per cent", "percent")]
#: A canonical line that begins so states a copyright and nothing else.
NOTICES = ["copyright c ", "copyright 19", "copyright 20", "c 19", "c 20", "portions copyright "]
RESERVED = "all rights reserved"
#: What begins a notice on the line of a copyright.
STARTS = ["licensed under", "released under", "this work is licensed", "spdx license identifier", "permission is", "permission to", "redistribution and use", "this program is free", "this library is free", "this software is"]
STATEMENT = f"^(?:{'|'.join(NOTICES)}).*? ((?:{'|'.join(STARTS)}) .*)$"

#: Known licences and one-line notices, as published.
KNOWN: list[tuple[str, str]] = [
    ("MIT", """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """ISC License

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("Zlib", """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""),
    ("0BSD", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
    ("BSD-2-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""),
    ("BSL-1.0", """Boost Software License - Version 1.0 - August 17th, 2003

Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("Unlicense", """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>"""),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""),
    ("GPL-3.0-or-later", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.

You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."""),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-3.0-or-later", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0-only"),
    ("LGPL-2.1-only", "SPDX-License-Identifier: LGPL-2.1-only"),
    ("AGPL-3.0-only", "SPDX-License-Identifier: AGPL-3.0-only"),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Released under CC0 1.0."),
]


#: Digests and lengths of the canonical forms of longer licences, as published.
WHOLE: list[tuple[str, str, int]] = [
    ("Apache-2.0", "67be1a38791c0b85d97d666ff22b5709e861b6e379a53626a2828ed0b4187e10", 9924),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f", 6692),
    ("GFDL-1.2-only", "f97f16d3f85c9f18bf17d8f365d2c4d004fd4ac8b2f0da913d99aee6ec362f1b", 19583),
    ("GFDL-1.3-only", "4c820a11a82b554b7ba49e1214d52fdeb808eca24bc1e5afb24170c4c6b8ab9a", 22019),
    ("GPL-1.0-only", "64de817eb1a5a82223fe2ad42bdcf455d81c696e9c91075a6eb0467138eb3811", 11764),
    ("GPL-2.0-only", "88fc323ac2b13feeead2938811ff69d9fc00fae261895ce978488ff29d5c8f51", 17118),
    ("GPL-3.0-only", "c91c44d681c081114bbde40d00b8add19daba4de2e27d7094963339674d8880c", 33412),
    ("LGPL-2.0-only", "cca77003ab9843b46967bd4b63c561e8e8dca53ebfa90d41a1ca235224930703", 24133),
    ("LGPL-2.1-only", "fdba14dcddf7a7670afeda45112d74fbd045bf1ecc36269382a665ed9b4b890a", 25221),
    ("LGPL-3.0-only", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be", 7104),
    ("MPL-1.1", "26ba73e836ecb04fe87d5eca80ca27cff1afa2d7683455be1517bd23b8d27986", 22448),
    ("MPL-2.0", "f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a", 14341),
    ("Artistic-1.0", "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702", 5833),
]


def plain_line(line: str) -> str:
    """One line's canonical form; the twin in Python, for the table of known digests."""
    line = re.sub(PUNCTUATION, " ", line.translate(str.maketrans(UPPER, LOWER)))
    for a, b in EQUIVALENT:
        line = line.replace(a, b)
    return re.sub(STATEMENT, r"\1", line.strip(" "))


def plain_text(text: str) -> str:
    lines = (plain_line(x) for x in text.split("\n"))
    return " ".join(x for x in lines if x and x != RESERVED and not x.startswith(tuple(NOTICES)))


def known_digests() -> list[tuple[str, str, int]]:
    """(licence, digest, length of the canonical text), once for each digest."""
    found = {digest: (name, n) for name, digest, n in WHOLE}
    for name, text in KNOWN:
        c = plain_text(text)
        found[hashlib.sha256(c.encode()).hexdigest()] = (name, len(c))
    return [(name, digest, n) for digest, (name, n) in found.items()]


def canonical_lines(text: Column) -> Column:
    """Canonical lines that are neither empty nor a statement of copyright."""
    # the whole text at once, then its lines: line feeds are no punctuation
    whole = F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), PUNCTUATION, " ")
    for a, b in EQUIVALENT:
        whole = F.replace(whole, F.lit(a), F.lit(b))
    lines = F.transform(F.split(whole, "\n", -1), lambda x: F.btrim(x, F.lit(" ")))
    lines = F.transform(lines, lambda x: F.when(reduce(lambda p, q: p | q, (x.startswith(n) for n in NOTICES)), F.regexp_replace(x, STATEMENT, "$1")).otherwise(x))
    return F.filter(lines, lambda x: (x != "") & (x != RESERVED) & ~reduce(lambda p, q: p | q, (x.startswith(n) for n in NOTICES)))


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """doc_id, canonical_sha256, license_id (of the whole text, or null) and notice_ids (of single lines, sorted, comma-joined)."""
    digests = lambda x: F.transform(x, lambda line: F.sha2(line.cast("binary"), 256))
    rows = docs.select("doc_id", canonical_lines(F.col("text")).alias("lines"))
    whole = F.sha2(F.array_join("lines", " ").cast("binary"), 256).alias("canonical_sha256")
    if known is None:
        table = known_digests()
        lengths = sorted({n for _, _, n in table})
        names = F.create_map(*(F.lit(x) for name, digest, _ in table for x in (digest, name)))
        lines = F.array_distinct(F.filter("lines", lambda x: F.length(x).isin(lengths)))
        notices = F.array_sort(F.array_distinct(F.filter(F.transform(digests(lines), lambda d: F.element_at(names, d)), lambda x: x.isNotNull())))
        rows = rows.select("doc_id", whole, F.array_join(notices, ",").alias("notice_ids"))
        values = ", ".join(f"('{name}', '{digest}')" for name, digest, _ in table)
        known = docs.sparkSession.sql(f"SELECT * FROM VALUES {values} AS known(license_id, digest)")
    else:
        content = F.array_sort(F.array_distinct(digests(F.col("lines"))))
        rows = rows.select("doc_id", whole, content.alias("lines")).withColumn("content", F.sha2(F.array_join("lines", ","), 256))
        some = rows.select("content", "lines").dropDuplicates(["content"]).select("content", F.explode("lines").alias("digest"))
        found = some.join(known.select("digest", "license_id"), "digest").groupBy("content").agg(F.array_join(F.array_sort(F.collect_set("license_id")), ",").alias("notice_ids"))
        rows = rows.drop("lines").join(found, "content", "left")
    return rows.join(known.select(F.col("digest").alias("canonical_sha256"), "license_id"), "canonical_sha256", "left").select("doc_id", "canonical_sha256", "license_id", F.coalesce("notice_ids", F.lit("")).alias("notice_ids"))


def op8_license_scan(spark, sf_dir: str) -> DataFrame:
    """Known licences of every document."""
    from .common import documents

    return scan(documents(spark, sf_dir).select("doc_id", "text"))


def oracle() -> str:
    """The same in DuckDB's SQL."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    whole = f"regexp_replace(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{PUNCTUATION}', ' ', 'g')"
    for a, b in EQUIVALENT:
        whole = f"replace({whole}, {quote(a)}, {quote(b)})"
    starts = " OR ".join(f"starts_with(x, {quote(n)})" for n in NOTICES)
    values = ", ".join(f"({quote(n)}, {quote(d)})" for n, d, _ in known_digests())
    return f"""
WITH known(license_id, digest) AS (VALUES {values}),
cut AS (SELECT doc_id, unnest(string_split({whole}, chr(10))) AS x, generate_subscripts(string_split({whole}, chr(10)), 1) AS i FROM documents),
bare AS (SELECT doc_id, i, regexp_replace(trim(x, ' '), {quote(STATEMENT)}, '\1') AS x FROM cut),
lines AS (SELECT * FROM bare WHERE x <> '' AND x <> '{RESERVED}' AND NOT ({starts})),
notes AS (SELECT doc_id, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notice_ids FROM lines JOIN known ON digest = sha256(x) GROUP BY doc_id),
whole AS (SELECT d.doc_id, sha256(coalesce(string_agg(x, ' ' ORDER BY i), '')) AS canonical_sha256 FROM documents d LEFT JOIN lines l ON d.doc_id = l.doc_id GROUP BY d.doc_id)
SELECT w.doc_id, canonical_sha256, license_id, coalesce(notice_ids, '') AS notice_ids
FROM whole w LEFT JOIN known ON digest = canonical_sha256 LEFT JOIN notes n ON n.doc_id = w.doc_id"""
