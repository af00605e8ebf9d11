"""License scans by sentence rules.

Texts are cut into sentences. A sentence may go on over single line breaks (with comment marks), colons and semicolons,
up to a full stop or a blank line; the shortest runs of its pieces that are known are taken, so each line also counts
alone, and then run on to the end of their sentence where that is known as the same. A normalised sentence (lower case, no punctuation, years and holders reduced) is mapped to
the identifier of a known licence sentence, and the sequence of identifiers in a text is matched, longest rule first,
against ordered licence rules. Sentences of the licence texts themselves are looked up; references with parts of their own
(versions, names) are matched by patterns. Between the sentences of a rule others that are not known are passed over up to
a given gap, and so are copyright lines and the like.

Cases: null and empty texts match nothing; a licence that occurs again is told again; equal rows have equal results;
a text without any of the words that the known sentences need is not cut at all. Positions are code points.
"""

from __future__ import annotations

import re
from re import _parser

import pyarrow as pa
from pyspark.sql import DataFrame

from leafmill.functions.session import arrow_rows

#: Parts of normalised texts, of which each pattern below needs one.
_HINTS = ("licen", "copyright", "©", "rights reserved", "permission", "as is", "liable", "applicable law", "gpl", "in the hope that", "redistribut", "endorse or promote", "creative commons", "cc by", "ccby", "cc0", "public domain", "spdx")
_SENTENCE = re.compile(r"[^\n]+?(?:[.;:!?]+(?=[\s\"')]|$)|(?=\n)|$)")
#: Identifiers of known licence sentences, with what their normalised form matches.
SENTENCES = [
    ("all-rights", r"all rights reserved"),
    ("copyright", r"(?:copyright|©)(?: c)? (?:y )*.{1,80}"),
    ("mit-ref", r"(?:released|licensed|distributed|available)? ?(?:code is )?(?:released |licensed |distributed )?under (?:the )?(?:terms of (?:the )?)?mit(?: \w+)? licen[sc]e|(?:the )?mit licen[sc]e(?: mit)?"),
    ("mit-grant", r"permission is hereby granted free of charge to any person obtaining a copy of this software .{0,400}"),
    ("mit-cond", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("as-is", r".{0,60}(?:software|work|program|code) is provided (?:by the copyright holders and contributors )?as is.{0,300}"),
    ("no-liability", r"in no event shall .{0,120} liable .{0,400}"),
    ("apache-ref", r"(?:.{0,40} )?licensed under (?:the )?apache licen[sc]e(?: version)? 2(?: 0)?(?: the license)?"),
    ("apache-comply", r"you may not use this (?:file|work) except in compliance with the license"),
    ("apache-obtain", r"you may obtain a copy of the license at.{0,80}"),
    ("apache-basis", r"unless required by applicable law .{0,100} distributed on an as is basis.{0,120}"),
    ("gpl-ref-3", r"(?:.{0,60} )?(?:licensed|released|distributed) under (?:the )?(?:terms of the )?(?:gnu )?(?:general public licen[sc]e|gpl)(?: as published by the free software foundation)?(?: either)?(?: version| v)? ?3(?: 0)?.{0,60}"),
    ("gpl-ref-2", r"(?:.{0,60} )?(?:licensed|released|distributed) under (?:the )?(?:terms of the )?(?:gnu )?(?:general public licen[sc]e|gpl)(?: as published by the free software foundation)?(?: either)?(?: version| v)? ?2(?: 0)?.{0,60}"),
    ("gpl-free", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license.{0,160}"),
    ("gpl-hope", r"this program is distributed in the hope that it will be useful.{0,160}"),
    ("gpl-copy", r"you should have received a copy of the gnu (?:lesser |affero )?general public license.{0,120}"),
    ("lgpl-ref", r"(?:.{0,60} )?under (?:the )?(?:terms of the )?(?:gnu )?(?:lesser general public licen[sc]e|lgpl).{0,60}"),
    ("agpl-ref", r"(?:.{0,60} )?under (?:the )?(?:terms of the )?(?:gnu )?(?:affero general public licen[sc]e|agpl).{0,60}"),
    ("bsd-ref", r"(?:.{0,60} )?under (?:the |a )?(?:(?:2|3|two|three) clause |new |modified |simplified )?bsd(?: style)? licen[sc]e"),
    ("bsd-grant", r"redistribution and use in source and binary forms with or without modification are permitted.{0,100}"),
    ("bsd-source", r"(?:1 )?redistributions of source code must retain the above copyright notice.{0,160}"),
    ("bsd-binary", r"(?:2 )?redistributions in binary form must reproduce the above copyright notice.{0,200}"),
    ("bsd-names", r"(?:3 )?neither the name of .{0,160} may be used to endorse or promote products.{0,120}"),
    ("mpl-ref", r"(?:.{0,80} )?(?:under|to) (?:the )?(?:terms of the )?mozilla public licen[sc]e.{0,40}"),
    ("isc-grant", r"permission to use copy modify and or distribute this software for any purpose .{0,160}"),
    ("cc-by-nc-nd", r"(?:.{0,60} )?(?:licensed|released) under (?:a |the )?(?:cc|creative commons)(?: attribution)? ?by nc nd(?: \d(?: \d)?)?.{0,40}"),
    ("cc-by-nc-sa", r"(?:.{0,60} )?(?:licensed|released) under (?:a |the )?(?:cc|creative commons)(?: attribution)? ?by nc sa(?: \d(?: \d)?)?.{0,40}"),
    ("cc-by-nc", r"(?:.{0,60} )?(?:licensed|released) under (?:a |the )?(?:cc|creative commons)(?: attribution)? ?by nc(?: \d(?: \d)?)?.{0,40}"),
    ("cc-by-sa", r"(?:.{0,60} )?(?:licensed|released) under (?:a |the )?(?:cc|creative commons)(?: attribution)? ?by sa(?: \d(?: \d)?)?.{0,40}"),
    ("cc-by-nd", r"(?:.{0,60} )?(?:licensed|released) under (?:a |the )?(?:cc|creative commons)(?: attribution)? ?by nd(?: \d(?: \d)?)?.{0,40}"),
    ("cc-by", r"(?:.{0,60} )?(?:licensed|released) under (?:a |the )?(?:cc|creative commons)(?: attribution)? ?by(?: \d(?: \d)?)?.{0,40}"),
    ("cc0", r".{0,60}(?:cc0|creative commons zero).{0,60}"),
    ("public-domain", r".{0,80}(?:released|placed|dedicated|is) (?:in|into|to) the public domain.{0,40}"),
    ("spdx", r"(?:.{0,10} )?spdx license identifier .{1,60}"),
]
#: Licence, and the sequence of sentence identifiers that makes it.
RULES = [
    ("MIT", ("mit-grant", "mit-cond", "as-is", "no-liability")),
    ("MIT", ("mit-grant", "mit-cond", "as-is")),
    ("MIT", ("mit-grant", "mit-cond")),
    ("MIT", ("mit-ref",)),
    ("Apache-2.0", ("apache-ref", "apache-comply", "apache-obtain", "apache-basis")),
    ("Apache-2.0", ("apache-ref", "apache-comply")),
    ("Apache-2.0", ("apache-ref",)),
    ("GPL", ("gpl-free", "gpl-hope", "gpl-copy")),
    ("GPL", ("gpl-free", "gpl-hope")),
    ("GPL", ("gpl-free",)),
    ("GPL-3.0", ("gpl-ref-3",)),
    ("GPL-2.0", ("gpl-ref-2",)),
    ("LGPL", ("lgpl-ref",)),
    ("AGPL", ("agpl-ref",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names", "as-is", "no-liability")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "as-is", "no-liability")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("BSD", ("bsd-ref",)),
    ("MPL", ("mpl-ref",)),
    ("ISC", ("isc-grant", "as-is", "no-liability")),
    ("ISC", ("isc-grant",)),
    ("CC-BY-NC-ND", ("cc-by-nc-nd",)),
    ("CC-BY-NC-SA", ("cc-by-nc-sa",)),
    ("CC-BY-NC", ("cc-by-nc",)),
    ("CC-BY-SA", ("cc-by-sa",)),
    ("CC-BY-ND", ("cc-by-nd",)),
    ("CC-BY", ("cc-by",)),
    ("CC0", ("cc0",)),
    ("Public-Domain", ("public-domain",)),
    ("SPDX", ("spdx",)),
    ("Proprietary", ("copyright", "all-rights")),
    ("Proprietary", ("all-rights",)),
]
#: Sentences of licence texts as they stand, by the identifier that they share with the patterns.
TEXTS = {
    "mit-grant": [
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the
        "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
        distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the
        following conditions:""",
    ],
    "mit-cond": ["The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "as-is": [
        """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.""",
        """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
        LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.""",
        """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
        MERCHANTABILITY AND FITNESS.""",
    ],
    "no-liability": [
        """IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT,
        TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
        """IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
        CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS
        INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
        OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
        """IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
        LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE
        USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ],
    "apache-ref": ["Licensed under the Apache License, Version 2.0 (the \"License\");"],
    "apache-comply": ["you may not use this file except in compliance with the License."],
    "apache-obtain": ["You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "apache-basis": [
        """Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.""",
    ],
    "apache-terms": ["See the License for the specific language governing permissions and limitations under the License."],
    "gpl-free": [
        """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by
        the Free Software Foundation; either version 2 of the License, or (at your option) any later version.""",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by
        the Free Software Foundation, either version 3 of the License, or (at your option) any later version.""",
    ],
    "gpl-hope": [
        """This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
        MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
    ],
    "gpl-copy": ["You should have received a copy of the GNU General Public License along with this program."],
    "bsd-grant": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "bsd-source": ["Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."],
    "bsd-binary": [
        """Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
        documentation and/or other materials provided with the distribution.""",
    ],
    "isc-grant": [
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the
        above copyright notice and this permission notice appear in all copies.""",
    ],
}
#: Sentences that stand between those of a rule without a part in it.
ASIDE = frozenset(("copyright", "all-rights", "apache-terms"))
_KNOWN = [(name, re.compile(pattern)) for name, pattern in SENTENCES]
#: Characters that any known sentence has at most; years of a copyright line are counted as 400 characters.
_WIDEST = 400 + max(
    *(w for w in (_parser.parse(pattern).getwidth()[1] for _, pattern in SENTENCES) if w < 10_000), *(len(t) for texts in TEXTS.values() for t in texts)
)
_ORDERED = sorted(RULES, key=lambda r: -len(r[1]))


def normalise(sentence: str) -> str:
    flat = " ".join(re.sub(r"[^\w©]+|_", " ", sentence.lower()).split())
    return re.sub(r"\b(?:19|20)\d\d\b", "y", flat)


def hinted(flat: str) -> bool:
    return any(h in flat for h in _HINTS)


_DICTIONARY = {normalise(text): name for name, texts in TEXTS.items() for text in texts}


def identify(sentence: str) -> str | None:
    return _identify(normalise(sentence))


def _identify(flat: str) -> str | None:
    """The identifier of a known sentence: by look-up, else by the patterns of sentences with parts of their own."""
    name = _DICTIONARY.get(flat)
    if name is None and hinted(flat):
        name = next((name for name, pattern in _KNOWN if pattern.fullmatch(flat)), None)
    return name


def _sentence(pieces: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """(start, end, identifier) of what is known in the pieces (start, end, normalised) of one sentence."""
    n = len(pieces)
    if not hinted(" ".join(p[2] for p in pieces)):
        return []
    first: list[tuple[int, str] | None] = []  # for each piece the shortest known run from it: its end, its identifier
    for i in range(n):
        flat, known = "", None
        for j in range(i, n):
            flat = f"{flat} {pieces[j][2]}" if flat else pieces[j][2]
            if j > i and len(flat) > _WIDEST:
                break
            name = _identify(flat)
            if name:
                known = (j, name)
                break
        first.append(known)
    out, i = [], 0
    while i < n:
        if first[i] is None or any(first[k] and first[k][0] <= first[i][0] and first[k][1] == first[i][1] for k in range(i + 1, first[i][0] + 1)):
            i += 1
            continue
        j, name = first[i]
        if name != "copyright" and j < n - 1 and not any(first[j + 1 :]) and _identify_run(pieces[i:]) == name:
            j = n - 1
        out.append((pieces[i][0], pieces[j][1], name))
        i = j + 1
    return out


def _identify_run(pieces: list[tuple[int, int, str]]) -> str | None:
    return _identify(" ".join(p[2] for p in pieces))


def sentences(text: str) -> list[tuple[int, int, str]]:
    """(start, end, identifier) of the known licence sentences of a text."""
    if not hinted(normalise(text)):
        return []
    out: list[tuple[int, int, str]] = []
    run: list[tuple[int, int, str]] = []
    line_end = 0
    for m in _SENTENCE.finditer(text):
        flat = normalise(m[0])
        if text.count("\n", line_end, m.start()) > 1 or not flat:  # a blank line, or one of comment marks only
            out += _sentence(run) if run else []
            run = []
        line_end = m.end()
        if flat:
            run.append((m.start(), m.end(), flat))
            if m[0][-1] in ".!?":
                out += _sentence(run)
                run = []
    return out + (_sentence(run) if run else [])


def match(found: list[tuple[int, int, str]], gap: int = 2000) -> list[tuple[str, int, int, int]]:
    """(licence, start, end, number of sentences): rules on a sequence of identifiers, longest first at each place.

    Sentences of ASIDE may stand between those of a rule; rules that name them take them where they stand.
    """

    def places(i: int, rule: tuple[str, ...]) -> list[int]:
        out = []
        for name in rule:
            while out and i < len(found) and found[i][2] != name and found[i][2] in ASIDE:
                i += 1
            if i >= len(found) or found[i][2] != name or out and found[i][0] - found[out[-1]][1] > gap:
                return []
            out.append(i)
            i += 1
        return out

    out, i = [], 0
    taken: set[int] = set()
    while i < len(found):
        if i not in taken:
            for licence, rule in _ORDERED:
                at = places(i, rule)
                if at and not taken.intersection(at):
                    out.append((licence, found[at[0]][0], found[at[-1]][1], len(rule)))
                    taken.update(at)
                    break
        i += 1
    return out


_FOUND = "array<struct<license:string,start:long,end:long,sentences:long>>"
_ARROW = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("sentences", pa.int64())]))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, licenses) of every row of df; licenses: array of (license, start, end, sentences)."""
    arrow_rows(df.sparkSession)
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            found = [[dict(zip(("license", "start", "end", "sentences"), x, strict=True)) for x in match(sentences(t))] if t else [] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, _ARROW)], ["doc_id", "licenses"])

    return df.select(df[id_col].alias("doc_id"), df[text_col].alias("text")).mapInArrow(run, f"doc_id {kind}, licenses {_FOUND}")
