"""License scan with a positional rare-token index.

Templates are word sequences (notices and whole licence bodies) with a label
and mandatory key phrases. Every template word has an IDF, measured over *all*
texts. The index holds postings ``word -> (template, position)`` of each
template's *lead* words: its highest-IDF words, as many as it takes that a
match, which may miss words of weight ``1 - MATCH`` only, still holds two of
them (one, if the template is that short). A file looks its licence words up
in the postings, highest IDF first; words that lead no template are passed
over. An occurrence at text position p posted at position o proposes that the
template begins at p - o, and postings are intersected by that relative
position: proposals of two different lead words must agree up to a small
shift, so an inserted or missing word does not break them. The cost follows
the postings of a file's own words, not the number of templates.

A surviving proposal is verified: the heaviest chain of template words that
stand in order within the shift gives the score, the IDF-weighted share of the
template; it counts from ``MATCH`` on, and only where every key phrase stands
word by word. A *base* template must match whole, at every place; it has one
lead word and no shift, so each place is proposed exactly once.

Words: A-Z lower-cased runs of digits, letters and non-ASCII characters.
Defined results: null, empty and wordless texts have no words, no labels
(empty strings), null places and score 0. Very long texts are scanned whole.
Repeated rows are scanned each; words that tie in IDF lead in text order. An
empty table gives no rows. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import share, shared_value
from .textunits import LOWER, NOT_ALNUM, Units, text_slices

MATCH = 0.8
SHIFT_WORDS = 8           # one word of shift for so many words of a template
SHIFT = 8                 # words of shift at most


@dataclass(frozen=True)
class Template:
    label: str
    words: str
    keys: tuple[str, ...] = field(default=())
    base: bool = False


# fixed values: base phrases
BASE = (
    Template("mit", "mit license", base=True),
    Template("apache", "apache license", base=True),
    Template("gpl", "general public license", base=True),
)
# licence notices known in advance (fixed values)
NOTICES = (
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
             ("permission is hereby granted", "free of charge")),
    Template("mit", "spdx license identifier mit", ("license identifier mit",)),
    Template("apache", "licensed under the apache license version 2 0", ("apache license",)),
    Template("apache", "spdx license identifier apache 2 0", ("license identifier apache",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
             ("redistribution and use", "source and binary forms")),
    Template("bsd", "bsd 3 clause license", ("bsd 3 clause",)),
    Template("bsd", "bsd 2 clause license", ("bsd 2 clause",)),
    Template("gpl", "licensed under the gnu general public license version 3", ("general public license",)),
    Template("gpl", "either version 3 of the license or at your option any later version",
             ("of the license", "any later version")),
    Template("lgpl", "gnu lesser general public license", ("lesser general public license",)),
    Template("agpl", "gnu affero general public license", ("affero general public license",)),
    Template("mpl", "mozilla public license", ("mozilla public license",)),
    Template("cc-by", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc-by", "creative commons attribution 4 0 international license", ("creative commons attribution",)),
    Template("proprietary", "all rights reserved", ("all rights reserved",)),
)


# licence bodies (fixed values, their words only)
MIT_BODY = """
permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation
files the software to deal in the software without restriction including without limitation the rights to use copy modify
merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is
furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be
included in all copies or substantial portions of the software the software is provided as is without warranty of any kind
express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and
noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability
whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or
other dealings in the software
"""
BSD_CONDITIONS = """
redistribution and use in source and binary forms with or without modification are permitted provided that the following
conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the
following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and
the following disclaimer in the documentation and or other materials provided with the distribution
"""
BSD_NAMES = """
neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission
"""
BSD_DISCLAIMER = """
this software is provided by the copyright holders and contributors as is and any express or implied warranties including
but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no
event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or
consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits
or business interruption however caused and on any theory of liability whether in contract strict liability or tort
including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of
such damage
"""
ISC_BODY = """
permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
provided that the above copyright notice and this permission notice appear in all copies the software is provided as is and
the author disclaims all warranties with regard to this software including all implied warranties of merchantability and
fitness in no event shall the author be liable for any special direct indirect or consequential damages or any damages
whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action
arising out of or in connection with the use or performance of this software
"""
ZLIB_BODY = """
this software is provided as is without any express or implied warranty in no event will the authors be held liable for any
damages arising from the use of this software permission is granted to anyone to use this software for any purpose
including commercial applications and to alter it and redistribute it freely subject to the following restrictions the
origin of this software must not be misrepresented you must not claim that you wrote the original software if you use this
software in a product an acknowledgment in the product documentation would be appreciated but is not required altered
source versions must be plainly marked as such and must not be misrepresented as being the original software this notice
may not be removed or altered from any source distribution
"""
UNLICENSE_BODY = """
this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile
sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non
commercial and by any means
"""
APACHE_NOTICE = """
licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license
you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed
to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of
any kind either express or implied see the license for the specific language governing permissions and limitations under
the license
"""
GPL_NOTICE = """
this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as
published by the free software foundation either version 3 of the license or at your option any later version this program
is distributed in the hope that it will be useful but without any warranty without even the implied warranty of
merchantability or fitness for a particular purpose see the gnu general public license for more details
"""
MPL_NOTICE = """
this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed
with this file you can obtain one at https mozilla org mpl 2 0
"""
BODIES = (
    Template("mit", MIT_BODY, ("permission is hereby granted", "without restriction", "the software is provided as is")),
    Template("bsd-3-clause", BSD_CONDITIONS + BSD_NAMES + BSD_DISCLAIMER,
             ("redistribution and use", "neither the name", "endorse or promote products")),
    Template("bsd-2-clause", BSD_CONDITIONS + BSD_DISCLAIMER, ("redistribution and use", "the distribution this software is")),
    Template("isc", ISC_BODY, ("for any purpose with or without fee", "the author disclaims all warranties")),
    Template("zlib", ZLIB_BODY, ("must not be misrepresented", "plainly marked as such")),
    Template("unlicense", UNLICENSE_BODY, ("free and unencumbered software",)),
    Template("apache", APACHE_NOTICE, ("apache license", "in compliance with the license")),
    Template("gpl", GPL_NOTICE, ("general public license", "free software foundation")),
    Template("mpl", MPL_NOTICE, ("mozilla public license",)),
)


def _hashes(words: str) -> np.ndarray:
    texts = next(iter(text_slices(pa.array([words], pa.string()))))
    return Units(texts, NOT_ALNUM).hashes()


class TemplateIndex:
    """IDF weights, key phrases and the postings of the lead words."""

    def __init__(self, templates: tuple[Template, ...], df: dict[int, int], texts: int):
        self.templates = templates
        self.words = [_hashes(t.words) for t in templates]
        self.vocabulary = np.unique(np.concatenate(self.words))
        idf = np.log((1 + texts) / (1 + np.array([df.get(int(h), 0) for h in self.vocabulary], dtype=float))) + 1e-6
        self.idf = idf
        self.at = [np.searchsorted(self.vocabulary, w) for w in self.words]
        self.weight = [idf[a] / idf[a].sum() for a in self.at]
        self.shift = [0 if t.base else min(SHIFT, len(a) // SHIFT_WORDS) for t, a in zip(templates, self.at)]
        self.leads, self.least = zip(*[self._leads(w, t.base) for t, w in zip(templates, self.weight)])
        self.keys = []
        for t, words in zip(templates, self.words):
            phrases = []
            for phrase in () if t.base else t.keys:
                p = _hashes(phrase)
                at = next(i for i in range(len(words)) if (words[i:i + len(p)] == p).all())
                phrases.append((at, np.searchsorted(self.vocabulary, p)))
            self.keys.append(phrases)
        posted = sorted((int(self.at[k][o]), k, int(o)) for k, lead in enumerate(self.leads) for o in lead)
        word = np.array([p[0] for p in posted], dtype=np.int64)
        self.template = np.array([p[1] for p in posted], dtype=np.int64)
        self.offset = np.array([p[2] for p in posted], dtype=np.int64)
        self.begin = np.searchsorted(word, np.arange(len(self.vocabulary) + 1))

    @staticmethod
    def _leads(weight: np.ndarray, base: bool) -> tuple[np.ndarray, int]:
        """Positions of the lead words and how many of them a match holds."""
        order = np.argsort(-weight, kind="stable")
        if base:
            return order[:1], 1
        for n in range(2, len(order) + 1):
            # missing all of them but one would cost more than a match may lack
            if weight[order[:n]].sum() - weight[order[0]] > 1 - MATCH + 1e-9:
                return order[:n], 2
        return order, 1

    def proposals(self, where: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(template, start, lead position) for each posting of a text's
        licence words, which stand at ``where``; rarest words first."""
        n = self.begin[word + 1] - self.begin[word]
        leading = np.flatnonzero(n)
        leading = leading[np.argsort(-self.idf[word[leading]], kind="stable")]
        n = n[leading]
        total = np.cumsum(n) - n
        at = np.repeat(self.begin[word[leading]] - total, n) + np.arange(int(n.sum()))
        return self.template[at], np.repeat(where[leading], n) - self.offset[at], self.offset[at]

    def starts(self, k: int, start: np.ndarray, lead: np.ndarray) -> np.ndarray:
        """Relative positions of template ``k`` on which enough different lead
        words agree, up to the shift."""
        order = np.argsort(start, kind="stable")
        start, lead = start[order], lead[order]
        unique = np.unique(start)
        if self.least[k] == 1:
            return unique
        lo = np.searchsorted(start, unique - self.shift[k])
        hi = np.searchsorted(start, unique + self.shift[k], side="right")
        return np.array([s for s, a, b in zip(unique, lo, hi) if len(np.unique(lead[a:b])) >= self.least[k]], dtype=np.int64)

    def whole(self, k: int, start: np.ndarray, where: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The starts at which template ``k`` stands word by word."""
        return start[_stand(self.at[k], start, where, word)]

    def score(self, k: int, start: int, where: np.ndarray, word: np.ndarray) -> float:
        """Weight of the heaviest chain of template ``k``'s words that stand in
        order around ``start``; 0 where a key phrase does not stand."""
        shift, size = self.shift[k], len(self.at[k])
        lo, hi = np.searchsorted(where, (start - shift, start + size + shift))
        at, words = where[lo:hi] - start, word[lo:hi]
        for o, phrase in self.keys[k]:
            first = np.arange(start + o - shift, start + o + shift + 1)
            if not _stand(phrase, first, where, word).any():
                return 0.0
        # (position, template position) pairs within the shift, by position and falling template position
        pairs = [(int(p), o) for p, w in zip(at, words)
                 for o in range(min(size - 1, int(p) + shift), max(-1, int(p) - shift - 1), -1) if self.at[k][o] == w]
        best = np.zeros(size + 1)               # heaviest chain that ends before a template position
        for _, o in pairs:
            now = best[o] + self.weight[k][o]
            if now > best[o + 1]:
                best[o + 1:] = np.maximum(best[o + 1:], now)
        return float(best[-1])

    def match(self, where: np.ndarray, word: np.ndarray) -> tuple[dict[int, np.ndarray], dict[int, float]]:
        """Places of the base templates and scores of the others in a text."""
        template, start, lead = self.proposals(where, word)
        places, scores = {}, {}
        for k in np.unique(template).tolist():
            mine = template == k
            found = self.starts(k, start[mine], lead[mine])
            if self.templates[k].base:
                found = self.whole(k, found, where, word)
                if len(found):
                    places[k] = found
            else:
                best = max((self.score(k, int(s), where, word) for s in found), default=0.0)
                if best >= MATCH - 1e-9:
                    scores[k] = best
        return places, scores


def _stand(phrase: np.ndarray, start: np.ndarray, where: np.ndarray, word: np.ndarray) -> np.ndarray:
    """For each start whether the words of ``phrase`` stand from there on."""
    spots = start[:, None] + np.arange(len(phrase))[None, :]
    found = np.minimum(np.searchsorted(where, spots), len(where) - 1)
    return ((where[found] == spots) & (word[found] == phrase[None, :])).all(axis=1)


def _word_hits(vocabulary: np.ndarray, units: Units) -> tuple[np.ndarray, np.ndarray]:
    h = units.hashes()
    at = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
    hit = np.flatnonzero(vocabulary[at] == h)
    return hit, at[hit]


def _frequencies(vocabulary: np.ndarray):
    def run(batches):
        df, texts_seen = np.zeros(len(vocabulary), np.int64), 0
        for batch in batches:
            for texts in text_slices(batch.column(0)):
                units = Units(texts, NOT_ALNUM, LOWER[texts.buf])
                hit, at = _word_hits(vocabulary, units)
                doc = np.searchsorted(units.bounds, hit, side="right") - 1
                pairs = np.unique(doc * len(vocabulary) + at)
                df += np.bincount(pairs % len(vocabulary), minlength=len(vocabulary))
                texts_seen += len(texts)
        yield pa.record_batch([pa.array([*vocabulary.view(np.int64), 0]), pa.array([*df, texts_seen]),
                               pa.array([False] * len(vocabulary) + [True])], names=["word", "df", "total"])
    return run


def _scan(shared):
    def run(batches):
        index = shared_value(shared)
        for batch in batches:
            out = {c: [] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")}
            for texts in text_slices(batch.column(1)):
                units = Units(texts, NOT_ALNUM, LOWER[texts.buf])
                hit, at = _word_hits(index.vocabulary, units)
                cut = np.searchsorted(hit, units.bounds)
                for i in range(len(texts)):
                    lo, hi = units.bounds[i], units.bounds[i + 1]
                    labels, base_labels, starts, best = set(), set(), [], 0.0
                    if cut[i + 1] - cut[i] > 1:
                        where, word = hit[cut[i]:cut[i + 1]] - lo, at[cut[i]:cut[i + 1]]
                        places, scores = index.match(where, word)
                        base_labels = {index.templates[k].label for k in places}
                        labels = base_labels | {index.templates[k].label for k in scores}
                        starts = list(places.values())
                        best = max([*scores.values(), *[1.0 for _ in places]], default=0.0)
                    starts = np.concatenate(starts) if starts else np.zeros(0, np.int64)
                    for c, value in zip(out, (int(hi - lo), len(starts), int(starts.min()) if len(starts) else None,
                                              int(starts.max()) if len(starts) else None,
                                              ",".join(sorted(base_labels)), ",".join(sorted(labels)), min(best, 1.0))):
                        out[c].append(value)
            kinds = {"base_labels": pa.string(), "labels": pa.string(), "score": pa.float64()}
            yield pa.record_batch([batch.column(0), *[pa.array(v, kinds.get(c, pa.int64())) for c, v in out.items()]],
                                  names=["doc_id", *out])
    return run


def license_scan(docs: DataFrame, templates: tuple[Template, ...] = BASE + NOTICES + BODIES, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_base`` (places of base
    phrases)``, first_word, last_word`` (their smallest and largest start)``,
    base_labels, labels`` (distinct, sorted, comma-joined) and ``score`` (best
    match, 0 to 1). Two passes over the texts: document frequencies of the
    template words (summed per task, then over tasks), then the scan."""
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    id_type = base.schema["doc_id"].dataType.simpleString()
    vocabulary = np.unique(np.concatenate([_hashes(t.words) for t in templates]))
    counted = (base.select("text").mapInArrow(_frequencies(vocabulary), "word long, df long, total boolean")
               .groupBy("word", "total").agg(F.sum("df").alias("df")).collect())   # one row per template word
    df = {r["word"] % (1 << 64): r["df"] for r in counted if not r["total"]}
    total = sum(r["df"] for r in counted if r["total"])
    shared = share(spark, TemplateIndex(templates, df, total))
    return base.mapInArrow(_scan(shared), f"doc_id {id_type}, n_words long, n_base long, first_word long, "
                                          "last_word long, base_labels string, labels string, score double")
