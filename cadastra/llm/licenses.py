"""License scans: passages of documents compared to license templates, in SQL functions only.

A document's passages are its whole text, its paragraphs, its lines and the sentences of
its lines. A passage and a template are compared by the Dice coefficient over the sets of their word
bigrams, after lower-casing and with everything but letters and digits taken as space.
Two sets of sizes a and b reach a coefficient t only if a lies between b t / (2 - t) and
b (2 - t) / t, so most templates are ruled out by size before any bigram is compared.
A match also shares at least the part t / (2 - t) of a template's bigrams. For each template a few of
its words are chosen that take part in more bigrams than may be missing, so a passage without any
of the chosen words matches nothing and is not taken apart.
A notice within a longer sentence, or wrapped over lines of a longer paragraph, is no passage. So around each
of a few chosen bigrams the text's words, over all lines and without marks, are also compared in windows of each template's size,
placed so that the bigram stands where the template has it. Of the windows around one bigram those nearest to a template
count, of equal ones the longest; and they count only for licenses that no passage of the document matches.
Templates are literals of the plan; documents are never shuffled, only their matches are.

Cases: a null or empty text, and a passage of fewer than two words, match nothing. A passage that
repeats in a document counts once. Of templates of one license the best match counts; equal ones
are the same result. Rows with the same id, null included, are read as one document. Texts of any
length are compared whole. An empty table gives no rows; clashing column names do not matter, since
only id and text are read.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Least Dice coefficient of a match.
THRESHOLD = 0.8

# Licenses by their SPDX tags; those of the GNU project have endings besides.
_TAGGED = (
    "MIT MIT-0 BSD-2-Clause BSD-3-Clause ISC 0BSD Zlib BSL-1.0 Unlicense WTFPL Apache-2.0 "
    "MPL-2.0 EPL-1.0 EPL-2.0 CC0-1.0 CC-BY-4.0 CC-BY-NC-4.0 CC-BY-SA-4.0 CC-BY-NC-SA-4.0 CC-BY-ND-4.0 CC-BY-NC-ND-4.0"
).split()
_GNU = "GPL-2.0 GPL-3.0 LGPL-2.1 LGPL-3.0 AGPL-3.0".split()

# The notices by which works name their license, the whole texts of the short licenses, the standard headers
# and, of the long texts, the passages by which they are known.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
        "Software is furnished to do so, subject to the following conditions:",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS "
        'PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT "
        "HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
        "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "MIT-0",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        'persons to whom the Software is furnished to do so. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, '
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
        "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
        "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        'distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
        "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
        "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE "
        "GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF "
        "LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT "
        "OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY "
        'THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, '
        "THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
        "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
        "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR "
        "BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT "
        "(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
        "POSSIBILITY OF SUCH DAMAGE.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
        'PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES '
        "OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
        "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
        "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
        "SOFTWARE.",
    ),
    (
        "0BSD",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        'granted. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
        "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY "
        "SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
        "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH "
        "THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for "
        "any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
        "restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the "
        "original software. If you use this software in a product, an acknowledgment in the product documentation would be "
        "appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be "
        "misrepresented as being the original software. 3. This notice may not be removed or altered from any source "
        "distribution.",
    ),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    (
        "BSL-1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        'accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, '
        "and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the "
        "Software is furnished to do so, all subject to the following:",
    ),
    (
        "Unlicense",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form "
        "or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    (
        "WTFPL",
        "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is "
        "allowed as long as the name is changed. DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE TERMS AND CONDITIONS FOR COPYING, "
        "DISTRIBUTION AND MODIFICATION 0. You just DO WHAT THE FUCK YOU WANT TO.",
    ),
    ("Apache-2.0", "This project is licensed under the Apache License 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        'applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License.",
    ),
    (
        "Apache-2.0",
        '"License" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through '
        "9 of this document.",
    ),
    ("Apache-2.0", '"Licensor" shall mean the copyright owner or entity authorized by the copyright owner that is granting the License.'),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version.",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later "
        "version.",
    ),
    (
        "LGPL-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) "
        "any later version.",
    ),
    (
        "LGPL-3.0",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("GPL-3.0", "The GNU General Public License is a free, copyleft license for software and other kinds of works."),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    (
        "GPL-2.0",
        "The licenses for most software are designed to take away your freedom to share and change it. By contrast, the GNU "
        "General Public License is intended to guarantee your freedom to share and change free software--to make sure the "
        "software is free for all its users. This General Public License applies to most of the Free Software Foundation's "
        "software and to any other program whose authors commit to using it. (Some other Free Software Foundation software is "
        "covered by the GNU Lesser General Public License instead.) You can apply it to your programs, too.",
    ),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    (
        "LGPL-3.0",
        "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU "
        "General Public License, supplemented by the additional permissions listed below.",
    ),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    (
        "LGPL-2.1",
        "This is the first released version of the Lesser GPL. It also counts as the successor of the GNU Library Public "
        "License, version 2, hence the version number 2.1.",
    ),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    (
        "AGPL-3.0",
        "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically "
        "designed to ensure cooperation with the community in the case of network server software.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    (
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which "
        "is available at https://www.eclipse.org/legal/epl-2.0",
    ),
    (
        "EPL-2.0",
        'THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE ("AGREEMENT"). ANY USE, '
        "REPRODUCTION OR DISTRIBUTION OF THE PROGRAM CONSTITUTES RECIPIENT'S ACCEPTANCE OF THIS AGREEMENT.",
    ),
    (
        "EPL-1.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 "
        "which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
    ),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    (
        "CC0-1.0",
        "The laws of most jurisdictions throughout the world automatically confer exclusive Copyright and Related Rights "
        '(defined below) upon the creator and subsequent owner(s) (each and all, an "owner") of an original work of',
    ),
    ("CC-BY-NC-SA-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    ("CC-BY-NC-ND-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    *((name, f"SPDX-License-Identifier: {name}") for name in _TAGGED),
    *((name, f"SPDX-License-Identifier: {name}{end}") for name in _GNU for end in ("", "-only", "-or-later")),
)

#: Words to be found in any text; they only decide where to look first.
_COMMON = frozenset("a all and any are by for from in is not of on or that the this to with without you".split())
_SPACE = r"[^\p{L}\p{N}]+"
_PARAGRAPH = r"\n[ \t\r]*\n"
#: A match of a passage has no digest, one of a window that of the window's bigrams.
_MATCHES = "array<struct<license:string,dice:double,digest:bigint>>"


def _raw_bigrams(text: str) -> list[str]:
    words = re.findall(r"[^\W_]+", text.lower())
    return [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def template_bigrams(text: str) -> list[str]:
    """The distinct word bigrams of a template, in order."""
    return list(dict.fromkeys(_raw_bigrams(text)))


def _may_be_missing(size: int, threshold: float) -> int:
    """How many of a template's bigrams a match may lack."""
    return int(size * (2 - 2 * threshold) / (2 - threshold) + 1e-9)


def words(passage: Column) -> Column:
    """The words of a passage, in lower case."""
    return F.split(F.trim(F.regexp_replace(F.lower(passage), _SPACE, " ")), " ")


def all_bigrams(words: str) -> Column:
    """The bigrams in a column of words, in order; empty for fewer than two. The column's name is asked
    for, since an expression in its place would be evaluated for every bigram."""
    own = F.col(words)
    seconds = F.slice(own, 2, F.greatest(F.size(own) - 1, F.lit(0)))
    return F.zip_with(F.slice(own, 1, F.size(seconds)), seconds, lambda a, b: F.concat(a, F.lit(" "), b))


def bigrams(words: str) -> Column:
    """The distinct bigrams in a column of words."""
    return F.array_distinct(all_bigrams(words))


def passages(text: Column) -> Column:
    """The distinct passages of a text."""
    sentences = F.split(F.regexp_replace(text, r"([.!?])\s+", "$1\n"), "\n")
    return F.array_distinct(F.concat(F.array(text), F.split(text, _PARAGRAPH), F.split(text, "\n"), sentences))


def _size_bounds(size: int, threshold: float) -> tuple[int, int]:
    """The sizes that a set may have to reach the threshold with one of `size`; one is added for rounding."""
    return max(1, int(size * threshold / (2 - threshold)) - 1), int(size * (2 - threshold) / threshold) + 1


def anchors(sets: Sequence[list[str]], threshold: float) -> list[str]:
    """Words of which any match holds at least one: few, chosen for as many templates as possible."""
    missing = [_may_be_missing(len(grams), threshold) for grams in sets]
    left = [[g.split(" ") for g in grams] for grams in sets]
    chosen: list[str] = []
    while wanting := [rest for rest, all_, may in zip(left, sets, missing, strict=True) if len(all_) - len(rest) <= may]:
        use = Counter(word for rest in wanting for gram in rest for word in set(gram))
        # long words are rare in other text; among short ones the longest is best
        chosen.append(min(use, key=lambda w: (0, -use[w], w) if len(w) >= 7 else (1 + (w in _COMMON), -len(w), w)))
        left = [[g for g in grams if chosen[-1] not in g] for grams in left]
    return chosen


def places(sets: Sequence[tuple[str, str]], threshold: float) -> dict[str, list[dict[str, int]]]:
    """Bigrams of which any match shares at least one, and where the templates have them: t the template, at the bigram's number,
    n the number of bigrams. For each template one more is chosen than may be missing, first those rare in other text."""
    bodies = [_raw_bigrams(body) for _, body in sets]
    found: dict[str, list[dict[str, int]]] = {}
    for body in bodies:
        grams = list(dict.fromkeys(body))
        plain = {g: sum(w in _COMMON or len(w) < 5 for w in g.split(" ")) for g in grams}
        grams.sort(key=lambda g: (plain[g], -len(g), g))
        found |= {g: [] for g in grams[: _may_be_missing(len(grams), threshold) + 1]}
    for number, body in enumerate(bodies):
        for at, gram in enumerate(body):
            if gram in found:
                found[gram].append({"t": number, "at": at, "n": len(body)})
    return found


def windows(pairs: str, sets: Sequence[tuple[str, str]], threshold: float) -> Column:
    """The distinct matches of windows in a column of a text's bigrams, which are in order and may repeat."""
    spots = places(sets, threshold)
    held = F.from_json(F.lit(json.dumps(spots)), "map<string,array<struct<t:int,at:int,n:int>>>")
    known = [{"license": name, "grams": template_bigrams(body)} for name, body in sets]
    known = F.from_json(F.lit(json.dumps(known)), "array<struct<license:string,grams:array<string>>>")
    text = F.col(pairs)

    def compared(at: Column, place: Column) -> Column:
        start, template = at - place["at"], F.get(known, place["t"])
        first = F.greatest(start, F.lit(0))
        grams = F.array_distinct(F.slice(text, first + 1, start + place["n"] - first))
        dice = F.lit(2.0) * F.size(F.array_intersect(grams, template["grams"])) / (F.size(grams) + F.size(template["grams"]))
        return F.struct(dice.alias("dice"), place["n"].alias("n"), template["license"].alias("license"), F.xxhash64(grams).alias("digest"))

    def nearest(around: Column) -> Column:
        rank = lambda m: F.struct(m["dice"], m["n"])
        return F.filter(around, lambda m: (m["dice"] >= threshold) & (rank(m) == F.array_max(F.transform(around, rank))))

    starts = F.filter(F.transform(text, lambda gram, at: F.struct(gram.alias("gram"), at.alias("at"))), lambda s: s["gram"].isin(*spots))
    around = F.transform(starts, lambda s: F.transform(F.element_at(held, s["gram"]), lambda place: compared(s["at"], place)))
    best = F.flatten(F.transform(around, nearest))
    return F.array_distinct(F.transform(best, lambda m: F.struct(m["license"], m["dice"], m["digest"])))


def scan(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """(doc id, license, best dice, n_matches) for each document and each license that a passage of it matches."""
    templates = [(name, body) for name, body in templates if template_bigrams(body)]
    sets = [(name, template_bigrams(body)) for name, body in templates]
    found = F.col("_grams")

    def matched(name: str, grams: list[str]) -> Column:
        least, most = _size_bounds(len(grams), threshold)
        shared = F.size(F.array_intersect(found, F.array(*map(F.lit, grams))))
        dice = F.lit(2.0) * shared / (F.size(found) + len(grams))
        return F.when(
            F.size(found).between(least, most) & (dice >= threshold),
            F.struct(F.lit(name).alias("license"), dice.alias("dice"), F.lit(None).cast("long").alias("digest")),
        )

    any_anchor = "|".join(map(re.escape, anchors([grams for _, grams in sets], threshold)))
    holds = rf"(?<![\p{{L}}\p{{N}}])(?:{any_anchor})(?![\p{{L}}\p{{N}}])"
    passage = F.col("_part._passage")
    rows = (
        docs.where(F.lower(text).rlike(holds))
        .select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"), words(F.col(text)).alias("_words"))
        .select("_id", "_text", all_bigrams("_words").alias("_pairs"))
        .select("_id", F.filter(passages(F.col("_text")), lambda p: F.lower(p).rlike(holds)).alias("_passages"), windows("_pairs", templates, threshold).alias("_windows"))
        # a row for each passage, and one for the windows
        .select("_id", F.explode(F.concat(
            F.transform("_passages", lambda p: F.struct(p.alias("_passage"), F.lit(None).cast(_MATCHES).alias("_windows"))),
            F.array(F.struct(F.lit(None).cast("string").alias("_passage"), F.col("_windows"))),
        )).alias("_part"))
        .select("_id", words(passage).alias("_words"), F.col("_part._windows").alias("_windows"))
        .select("_id", bigrams("_words").alias("_grams"), "_windows")
        .select("_id", F.explode(F.coalesce("_windows", F.array_compact(F.array(*(matched(*s) for s in sets))))).alias("m"))
    )
    by_passage = F.col("m.digest").isNull()
    best = rows.groupBy("_id", F.col("m.license").alias("license")).agg(
        F.coalesce(F.max(F.when(by_passage, F.col("m.dice"))), F.max("m.dice")).alias("dice"),
        F.coalesce(F.nullif(F.count_if(by_passage), F.lit(0)), F.count(F.lit(1))).alias("n_matches"),
    )
    return best.withColumnRenamed("_id", doc_id)
