"""License scan by ordered signature rules.

A rule is a label, a regular expression over lower-cased bytes, a priority and a
weight. Its keywords, of which one must occur before the rule is tried, are read from
the expression (``keywords_of``): every match contains one of them.
Every license of ``LICENSES`` gives the rules of ``FORMS`` (tag, name, grant,
link) where it has the part they need; ``NOTICES`` are rules of their own. One
pass of an Aho-Corasick automaton finds the keywords, which opens the rules.
Detections are resolved in order of priority: one that lies within the
interval of a detection of a higher priority, or of a longer one of the same
priority, is suppressed.

``scan`` returns the kept detections as spans of bytes with their labels, and
the base phrases (``PHRASES``): places where the words of a phrase stand
consecutively. Base labels are never suppressed.

Defined cases: a null text is the empty text (0 words, no label, score 0); a
repeated row gives a repeated result row; an empty table an empty result;
other columns are not read. Texts are scanned whole.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from re import _constants as sre
from re import _parser as sre_parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm.common import table, text_or_empty

# Words, the base phrases and their labels.
WORD = rb"[0-9a-z\x80-\xff]"
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: label | SPDX tag | name | link. Hand-written; a blank part gives no rule.
LICENSES = r"""
mit | mit | mit license | opensource\.org/licenses/mit\b
apache-2.0 | apache-2\.0 | apache (software )?license,? (version |v\.? ?)?2(\.0)? | apache\.org/licenses/license-2\.0
apache-1.1 | apache-1\.1 | apache software license,? version 1\.1 | apache\.org/licenses/license-1\.1
apache | | apache (software )?license |
bsd-2-clause | bsd-2-clause | (2|two)[ -]clause bsd( license)?|simplified bsd license|bsd 2[ -]clause | opensource\.org/licenses/bsd-2-clause
bsd-3-clause | bsd-3-clause | (3|three)[ -]clause bsd( license)?|(new|modified|revised) bsd license|bsd 3[ -]clause | opensource\.org/licenses/bsd-3-clause
bsd-4-clause | bsd-4-clause | (4|four)[ -]clause bsd( license)?|original bsd license |
bsd-0-clause | 0bsd | zero[ -]clause bsd( license)?|bsd zero[ -]clause |
bsd | | bsd( style)? license |
gpl-1.0 | gpl-1\.0(-only|-or-later|\+)? | gnu general public license,? (version |v\.? ?)1(\.0)? | gnu\.org/licenses/(old-licenses/)?gpl-1\.0
gpl-2.0 | gpl-2\.0(-only|-or-later|\+)? | gnu general public license,? (version |v\.? ?)2(\.0)?|gpl ?v2 | gnu\.org/licenses/(old-licenses/)?gpl-2\.0
gpl-3.0 | gpl-3\.0(-only|-or-later|\+)? | gnu general public license,? (version |v\.? ?)3(\.0)?|gpl ?v3 | gnu\.org/licenses/gpl(-3\.0)?(\.html|\.txt)?\b
gpl | gpl | gnu general public license|gnu gpl |
lgpl-2.0 | lgpl-2\.0(-only|-or-later|\+)? | gnu library general public license,? (version |v\.? ?)2(\.0)? | gnu\.org/licenses/(old-licenses/)?lgpl-2\.0
lgpl-2.1 | lgpl-2\.1(-only|-or-later|\+)? | gnu lesser general public license,? (version |v\.? ?)2\.1|lgpl ?v2\.1 | gnu\.org/licenses/(old-licenses/)?lgpl-2\.1
lgpl-3.0 | lgpl-3\.0(-only|-or-later|\+)? | gnu lesser general public license,? (version |v\.? ?)3(\.0)?|lgpl ?v3 | gnu\.org/licenses/lgpl-3\.0
lgpl | | gnu lesser general public license|gnu lgpl |
agpl-3.0 | agpl-3\.0(-only|-or-later|\+)? | (gnu )?affero general public license(,? (version |v\.? ?)3(\.0)?)?|agpl ?v3 | gnu\.org/licenses/agpl-3\.0
gfdl | gfdl-1\.[0-3](-only|-or-later)? | gnu free documentation license(,? version 1\.[0-3])? | gnu\.org/(licenses|copyleft)/fdl
mpl-1.1 | mpl-1\.1 | mozilla public license,? (version |v\.? ?)1\.1 | mozilla\.org/mpl/1\.1
mpl-2.0 | mpl-2\.0(-no-copyleft-exception)? | mozilla public license,? (version |v\.? ?)2(\.0)? | mozilla\.org/mpl/2\.0
mpl | | mozilla public license | mozilla\.org/mpl\b
epl-1.0 | epl-1\.0 | eclipse public license(,| -)? (version |v\.? ?)1(\.0)? | eclipse\.org/legal/epl-v10
epl-2.0 | epl-2\.0 | eclipse public license(,| -)? (version |v\.? ?)2(\.0)? | eclipse\.org/legal/epl-2\.0
epl | | eclipse public license |
cddl-1.0 | cddl-1\.[01] | common development and distribution license(,? (version |v\.? ?)1\.[01])? | opensource\.org/licenses/cddl
cpl-1.0 | cpl-1\.0 | common public license(,? (version |v\.? ?)1(\.0)?)? | opensource\.org/licenses/cpl
isc | isc | isc license | opensource\.org/licenses/isc
zlib | zlib | zlib(/libpng)? license | opensource\.org/licenses/zlib
libpng | libpng(-2\.0)? | libpng license |
bsl-1.0 | bsl-1\.0 | boost software license(,? (version |v\.? ?)1(\.0)?)? | boost\.org/license_1_0
unlicense | unlicense | the unlicense | unlicense\.org
wtfpl | wtfpl | do what the fuck you want to public license | wtfpl\.net
artistic-1.0 | artistic-1\.0(-perl|-cl8)? | artistic license,? (version )?1(\.0)? |
artistic-2.0 | artistic-2\.0 | artistic license,? (version )?2(\.0)? | opensource\.org/licenses/artistic-2\.0
artistic | | artistic license |
ofl-1.1 | ofl-1\.[01](-rfn|-no-rfn)? | (sil )?open font license(,? (version )?1\.[01])? | scripts\.sil\.org/ofl
eupl | eupl-1\.[0-2] | european union public licence(,? (version |v\.? ?)1\.[0-2])? |
osl-3.0 | osl-[1-3]\.[01] | open software license(,? (version |v\.? ?)[1-3]\.[01])? |
afl-3.0 | afl-[1-3]\.[01] | academic free license(,? (version |v\.? ?)[1-3]\.[01])? |
ms-pl | ms-pl | microsoft public license |
ms-rl | ms-rl | microsoft reciprocal license |
python-2.0 | (python-2\.0(\.1)?|psf-2\.0) | (python software foundation|psf) license |
php-3.01 | php-3\.0(1)? | php license(,? version 3\.0(1)?)? | php\.net/license/3_0
ruby | ruby | ruby license |
postgresql | postgresql | postgresql licen[cs]e | opensource\.org/licenses/postgresql
openssl | openssl | openssl license |
curl | curl | curl license |
ncsa | ncsa | university of illinois/ncsa open source license |
vim | vim | vim license |
x11 | x11 | x11 license |
icu | icu | icu license |
unicode | unicode-(dfs-201[56]|3\.0) | unicode license |
w3c | w3c(-1998[0-9]*|-2015[0-9]*)? | w3c software (notice and )?license | w3\.org/consortium/legal/
bittorrent | bittorrent-1\.[01] | bittorrent open source license |
upl-1.0 | upl-1\.0 | universal permissive license(,? (version |v\.? ?)1(\.0)?)? |
elastic-2.0 | elastic-2\.0 | elastic license(,? (version )?2(\.0)?)? | elastic\.co/licensing/elastic-license
sspl-1.0 | sspl-1\.0 | server side public license(,? (version |v\.? ?)1)? |
busl-1.1 | busl-1\.1 | business source license(,? 1\.1)? | mariadb\.com/bsl11
cc0-1.0 | cc0-1\.0 | cc0( 1\.0)?( universal)? | creativecommons\.org/publicdomain/zero/1\.0
cc-by-1.0 | cc-by-1\.0 | creative commons attribution 1\.0|cc[ -]by 1\.0 | creativecommons\.org/licenses/by/1\.0
cc-by-2.0 | cc-by-2\.[05] | creative commons attribution 2\.[05]|cc[ -]by 2\.[05] | creativecommons\.org/licenses/by/2\.[05]
cc-by-3.0 | cc-by-3\.0 | creative commons attribution 3\.0|cc[ -]by 3\.0 | creativecommons\.org/licenses/by/3\.0
cc-by-4.0 | cc-by-4\.0 | creative commons attribution 4\.0( international)?|cc[ -]by 4\.0 | creativecommons\.org/licenses/by/4\.0
cc-by-sa | cc-by-sa(-[1-4]\.[05])? | creative commons attribution[ -]share ?alike( [1-4]\.[05])?|cc[ -]by-sa( [1-4]\.[05])? | creativecommons\.org/licenses/by-sa/
cc-by-nc | cc-by-nc(-[1-4]\.[05])? | creative commons attribution[ -]non ?commercial( [1-4]\.[05])?|cc[ -]by-nc( [1-4]\.[05])? | creativecommons\.org/licenses/by-nc/
cc-by-nd | cc-by-nd(-[1-4]\.[05])? | creative commons attribution[ -]no ?deriv(ative)?s( [1-4]\.[05])?|cc[ -]by-nd( [1-4]\.[05])? | creativecommons\.org/licenses/by-nd/
cc-by-nc-sa | cc-by-nc-sa(-[1-4]\.[05])? | creative commons attribution[ -]non ?commercial[ -]share ?alike( [1-4]\.[05])?|cc[ -]by-nc-sa( [1-4]\.[05])? | creativecommons\.org/licenses/by-nc-sa/
cc-by-nc-nd | cc-by-nc-nd(-[1-4]\.[05])? | creative commons attribution[ -]non ?commercial[ -]no ?deriv(ative)?s( [1-4]\.[05])?|cc[ -]by-nc-nd( [1-4]\.[05])? | creativecommons\.org/licenses/by-nc-nd/
creative-commons | | creative commons |
odbl-1.0 | odbl-1\.0 | open (data commons )?(open )?database license(,? (version |v\.? ?)1(\.0)?)? | opendatacommons\.org/licenses/odbl
odc-by | odc-by-1\.0 | open data commons attribution license | opendatacommons\.org/licenses/by
pddl | pddl-1\.0 | public domain dedication and license | opendatacommons\.org/licenses/pddl
openrail | (bigscience-)?openrail(-m)? | (creativeml )?open ?rail([ +-]+m+)?( license)? |
"""

#: label | priority | weight | regular expression
NOTICES = r"""
copyright | 10 | 0.4 | copyright (\(c\)|\xc2\xa9|©)? ?(1[89]|20)[0-9]{2}
copyright | 10 | 0.4 | copyright (\(c\)|\xc2\xa9)
copyright | 10 | 0.4 | \xc2\xa9 ?(1[89]|20)[0-9]{2}
mit | 70 | 0.9 | permission is hereby granted, free of charge, to any person obtaining a copy
mit | 20 | 0.3 | the software is provided "as is", without warranty of any kind
isc | 70 | 0.9 | permission to use, copy, modify, and(/or)? distribute this software for any purpose with or without fee
bsd | 60 | 0.8 | redistribution and use in source and binary forms, with or without modification
bsd-3-clause | 65 | 0.8 | neither the name of .{1,80}? nor the names of its contributors may be used to endorse
bsd-4-clause | 70 | 0.9 | all advertising materials mentioning features or use of this software
gpl | 50 | 0.7 | under the terms of the gnu general public license
gpl | 45 | 0.6 | this program is free software[;:,] you can redistribute it
gpl | 30 | 0.5 | or \(at your option\) any later version
lgpl | 55 | 0.7 | under the terms of the gnu lesser general public license
agpl-3.0 | 60 | 0.8 | under the terms of the gnu affero general public license
apache-2.0 | 75 | 0.95 | licensed under the apache license,? version 2\.0
apache-2.0 | 40 | 0.6 | distributed on an "as is" basis, without warranties or conditions of any kind
zlib | 65 | 0.8 | the origin of this software must not be misrepresented
bsl-1.0 | 70 | 0.9 | distributed under the boost software license
mpl-2.0 | 75 | 0.95 | subject to the terms of the mozilla public license, v\. 2\.0
public-domain | 50 | 0.7 | (released|dedicated|placed) (in)?to the public domain
public-domain | 50 | 0.7 | (is|are|in) (in )?the public domain
unlicense | 70 | 0.9 | free and unencumbered software released into the public domain
reserved | 15 | 0.5 | (some|no) rights reserved
proprietary | 40 | 0.7 | (proprietary and confidential|confidential and proprietary)
proprietary | 35 | 0.6 | unauthorized (copying|use|distribution) (of this file )?.{0,40}?(is )?strictly prohibited
proprietary | 35 | 0.6 | contains trade secrets
proprietary | 30 | 0.6 | may not be (copied|reproduced|distributed|published)[a-z, ]{0,60} without (the )?(prior |express )*(written )?(permission|consent)
proprietary | 25 | 0.5 | end[ -]user license agreement
non-commercial | 30 | 0.6 | (for )?non-?commercial (use|purposes)( only)?
non-commercial | 30 | 0.6 | (not|prohibited) for commercial (use|purposes)
research-only | 30 | 0.6 | for (academic|research)( and (academic|research))? (use|purposes) only
"""

#: form, priority, weight, pattern around the license's part {}.
FORMS = (
    ("tag", 100, 1.0, r"spdx-license-identifier:\s*\(?(?:[a-z0-9.+-]+ (?:or|and|with) )?{}\)?(?![0-9a-z.+-])"),
    ("link", 80, 0.95, r"(?:https?://)?(?:www\.)?{}"),
    ("grant", 60, 0.9, r"(?:licen[cs]ed|released|distributed|available|published|covered|provided) "
                       r"(?:under|by|according to)(?: the)?(?: terms of)?(?: the)? (?:gnu )?(?:{})"),
    ("name", 40, 0.7, r"(?<![0-9a-z])(?:{})(?![0-9a-z])"),
)


@dataclass(frozen=True)
class Rule:
    label: str
    keywords: tuple[bytes, ...]
    priority: int
    weight: float
    pattern: re.Pattern


def keywords_of(pattern: bytes, often: Counter) -> tuple[bytes, ...]:
    """Strings of which every match of ``pattern`` contains one: of those that it allows the ones in
    the fewest expressions (``often``), then the longest."""

    def worth(words: frozenset[bytes]) -> tuple:
        shortest = min(map(len, words))
        return shortest >= 3, -max(often[w] for x in words for w in re.findall(rb"[a-z0-9]+", x) or [x]), shortest, sorted(words)

    def needed(items) -> frozenset[bytes] | None:
        found, run = [], bytearray()
        for op, value in [*items, (None, None)]:
            if op is sre.LITERAL:
                run.append(value)
                continue
            if run:
                found.append(frozenset([bytes(run)]))
                run = bytearray()
            part = None
            if op is sre.SUBPATTERN:
                part = needed(value[-1])
            elif op is sre.MAX_REPEAT or op is sre.MIN_REPEAT:
                part = needed(value[2]) if value[0] else None
            elif op is sre.BRANCH:
                each = [needed(branch) for branch in value[1]]
                part = None if None in each else frozenset().union(*each)
            if part:
                found.append(part)
        return max(found, key=worth, default=None)

    words = needed(sre_parser.parse(pattern))
    if not words:
        raise ValueError(f"a rule needs a string that all its matches contain: {pattern!r}")
    return tuple(sorted(words))


def rules() -> list[Rule]:
    """All rules, highest priority first; a longer, more specific name goes first."""
    out = []
    for line in LICENSES.strip().splitlines():
        label, tag, name, link = (x.strip() for x in re.split(r"(?<=\s)\|(?=\s|$)", line))
        part = {"tag": tag, "link": link, "grant": name, "name": name}
        versioned = bool(re.search(r"\d", label))
        for form, priority, weight, pattern in FORMS:
            if not part[form]:
                continue
            text = pattern.replace("{}", f"(?:{part[form]})").replace(" ", r"\s+")
            out.append((label, priority + versioned, weight, text.encode()))
    for line in NOTICES.strip().splitlines():
        label, priority, weight, pattern = (x.strip() for x in line.split(" | ", 3))
        out.append((label, int(priority), float(weight), pattern.replace("©", r"\xc2\xa9").replace(" ", r"\s+").encode()))
    often = Counter(w for *_, text in out for w in set(re.findall(rb"[a-z0-9]+", text)))
    made = [Rule(label, keywords_of(text, often), priority, weight, re.compile(text)) for label, priority, weight, text in out]
    return sorted(made, key=lambda r: -r.priority)


def phrase_pattern(phrase: str) -> re.Pattern:
    """The phrase's words one after the other, anything but words between."""
    gap = rb"[^0-9a-z\x80-\xff]+"
    return re.compile(rb"(?<!" + WORD + rb")" + gap.join(w.encode() for w in phrase.split()) + rb"(?!" + WORD + rb")")


def resolve(found: list[tuple[int, int, int, str, float]]) -> list[tuple[int, int, int, str, float]]:
    """Detections (priority, start, end, label, weight) that no detection of a
    higher priority contains, nor a longer or earlier one of the same."""
    kept: list[tuple[int, int, int, str, float]] = []
    by_priority = defaultdict(list)
    for x in dict.fromkeys(found):
        by_priority[x[0]].append(x)
    starts: list[int] = []
    reach: list[int] = []  # the furthest end of kept detections up to each start
    for priority in sorted(by_priority, reverse=True):
        tier, furthest = [], -1
        for x in sorted(by_priority[priority], key=lambda x: (x[1], -x[2], x[3])):
            k = bisect_right(starts, x[1])
            if x[2] <= furthest or k and reach[k - 1] >= x[2]:
                continue
            furthest = x[2]
            tier.append(x)
        kept += tier
        order = sorted(kept, key=lambda x: x[1])
        starts = [x[1] for x in order]
        reach = np.maximum.accumulate([x[2] for x in order]).tolist() if order else []
    return sorted(kept, key=lambda x: (x[1], x[2], x[3]))


class Scanner:
    def __init__(self):
        import ahocorasick
        self.rules = rules()
        self.phrases = [(phrase_pattern(p), label) for p, label in PHRASES.items()]
        opens = defaultdict(set)
        for k, rule in enumerate(self.rules):
            for key in rule.keywords:
                opens[key].add(k)
        for k, phrase in enumerate(PHRASES):  # its longest word opens a phrase
            opens[max(phrase.split(), key=len).encode()].add(-1 - k)
        self.keys = ahocorasick.Automaton()
        for key, which in opens.items():
            self.keys.add_word(key.decode(), frozenset(which))
        self.keys.make_automaton()
        self.is_word = np.zeros(256, bool)
        self.is_word[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True

    def scan(self, text: str) -> dict:
        low = text.encode().lower()  # of bytes: A-Z only
        inside = self.is_word[np.frombuffer(low, np.uint8)]
        begins = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1]))) if len(low) else np.array([], int)
        hit: set[int] = set()
        for _, which in self.keys.iter(low.decode()):
            hit |= which
        base, found = [], []
        for k in sorted(hit):
            if k < 0:
                pattern, label = self.phrases[-1 - k]
                base += [(m.start(), m.end(), label) for m in pattern.finditer(low)]
            else:
                r = self.rules[k]
                found += [(r.priority, *m.span(), r.label, r.weight) for m in r.pattern.finditer(low)]
        kept = resolve(found)
        base.sort()
        words = np.searchsorted(begins, [s for s, _, _ in base])
        return {"n_words": len(begins), "base": base, "base_words": words.tolist(), "detections": kept}


SCHEMA = ("n_words long, base array<struct<start:long,end:long,word:long,label:string>>, "
          "detections array<struct<priority:int,start:long,end:long,label:string,weight:double>>")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_words, base (spans, word index, label) and detections of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in batches:
            rows = [scanner.scan(t) for t in batch.column(1).to_pylist()]
            base = [[{"start": s, "end": e, "word": w, "label": x}
                     for (s, e, x), w in zip(r["base"], r["base_words"], strict=True)] for r in rows]
            kept = [[{"priority": p, "start": s, "end": e, "label": x, "weight": w}
                     for p, s, e, x, w in r["detections"]] for r in rows]
            span = [("start", pa.int64()), ("end", pa.int64())]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([r["n_words"] for r in rows], pa.int64()),
                pa.array(base, pa.list_(pa.struct([*span, ("word", pa.int64()), ("label", pa.string())]))),
                pa.array(kept, pa.list_(pa.struct([("priority", pa.int32()), *span, ("label", pa.string()),
                                                   ("weight", pa.float64())])))],
                [id_col, "n_words", "base", "detections"])

    src = docs.select(F.col(id_col), text_or_empty(text_col).alias("content"))
    return src.mapInArrow(run, f"`{id_col}` {src.schema[id_col].dataType.simpleString()}, {SCHEMA}")


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents. ``score``: 1 less the product of (1 - weight) over the kept
    labels, a base label counting 0.5."""
    found = scan(table(spark, sf_dir, "documents"))
    of_base = F.array_distinct(F.transform("base", lambda x: x["label"]))
    labels = F.array_distinct(F.concat(of_base, F.transform("detections", lambda x: x["label"])))
    words = F.transform("base", lambda x: x["word"])
    best = F.transform(labels, lambda x: F.greatest(
        F.when(F.array_contains(of_base, x), 0.5).otherwise(0.0),
        F.coalesce(F.array_max(F.transform(F.filter("detections", lambda d: d["label"] == x), lambda d: d["weight"])),
                   F.lit(0.0))))
    miss = F.aggregate(best, F.lit(1.0), lambda p, w: p * (F.lit(1.0) - w))
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(words).alias("first_word"),
        F.array_max(words).alias("last_word"), F.array_join(F.array_sort(of_base), ",").alias("base_labels"),
        F.array_join(F.array_sort(labels), ",").alias("labels"), (F.lit(1.0) - miss).alias("score"),
        F.size("detections").alias("n_detections"))
