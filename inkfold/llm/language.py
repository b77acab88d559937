"""Languages of documents and of the segments of mixed ones, by rank-order profiles.

A language's profile is its most frequent letter n-grams in order. A sentence is compared by out-of-place distance:
for each of its n-grams, how far its rank is from the rank in the profile, or the most possible if it isn't there.
The nearest profile names the language; how much farther the second one is gives the confidence.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkfold.operators.sampling import hash_sample
from inkfold.session import durable, widened

LANGUAGES = ("zh", "en", "de", "fr", "es", "pt", "ja")
# Names by which labels call the languages, in lower case; fixed values.
NAMES = {
    "zh": "zh zho chi cmn cn chinese mandarin 中文 汉语 漢語 普通话 chinesisch chinois chino chinês 中国語",
    "en": "en eng english 英语 英文 englisch anglais inglés inglês 英語",
    "de": "de deu ger german deutsch 德语 德文 allemand alemán alemão ドイツ語",
    "fr": "fr fra fre french français francais 法语 法文 französisch francés francês フランス語",
    "es": "es spa spanish español espanol castellano 西班牙语 spanisch espagnol espanhol スペイン語",
    "pt": "pt por portuguese português portugues 葡萄牙语 portugiesisch portugais portugués ポルトガル語",
    "ja": "ja jpn japanese 日本語 日语 日文 japanisch japonais japonés japonês",
}
_CODE = {name: code for code, names in NAMES.items() for name in names.split()}
#: A little of each language, so that profiles exist where no document is labelled.
SEEDS = {
    "zh": "我们今天在这里说的是一件很简单的事情，因为大家都知道市场不会总是上涨，所以他们还是要看自己有没有准备好。这个时候如果没有什么消息，那就等一等，不要着急。",
    "en": "What we say here is a simple thing, because everyone knows that the market does not always rise, and so they have to see whether they are ready. If there is no news at this time, then it is better to wait for it and not to be in a hurry.",
    "de": "Was wir hier sagen, ist eine einfache Sache, denn jeder weiß, dass der Markt nicht immer steigt, und deshalb müssen sie sehen, ob sie bereit sind. Wenn es zu dieser Zeit keine Nachrichten gibt, dann ist es besser zu warten und nicht in Eile zu sein.",
    "fr": "Ce que nous disons ici est une chose simple, parce que tout le monde sait que le marché ne monte pas toujours, et donc ils doivent voir s'ils sont prêts. S'il n'y a pas de nouvelles à ce moment, alors il vaut mieux attendre et ne pas être pressé.",
    "es": "Lo que decimos aquí es una cosa sencilla, porque todos saben que el mercado no siempre sube, y por eso tienen que ver si están listos. Si no hay noticias en este momento, entonces es mejor esperar y no tener prisa con las cosas.",
    "pt": "O que dizemos aqui é uma coisa simples, porque todos sabem que o mercado não sobe sempre, e por isso eles têm de ver se estão prontos. Se não há notícias neste momento, então é melhor esperar e não ter pressa com as coisas.",
    "ja": "ここで言うことは簡単なことです。市場がいつも上がるわけではないことは誰でも知っていますので、自分の準備ができているかどうかを見なければなりません。今ニュースがないのであれば、急がずに待つのがよいと思います。",
}
#: Longest n-gram and ranks per profile; labelled documents and their characters to learn from at most.
ORDER, DEPTH, TRAIN, TRAIN_CHARS = 4, 3_000, 6_000, 20_000_000
#: An n-gram with ideographs or kana counts as so many others, having about as many sounds.
WIDE_WEIGHT = 3

_ENTRY = re.compile(r"[\w.-]+\s*:|-\s|$")
_END = re.compile(r"[。！？!?]+[”』」\"')）]*|\.+[”\"')»]*(?=\s|$)|…+|[\r\n]+")
_MARKS, _QUOTES = "。！？!?.…", "”』」\"')）»"
_CLOSED = re.compile(rf"[{_MARKS}][{_QUOTES}]*\s*\Z")
_ODD = regex.compile(r"[\p{So}\p{Sk}\p{Cf}\p{No}\p{Me}\uFE0F]+")  # emoji and the like may stand within a word
_FIRST = regex.compile(r"[^\s\p{So}\p{Sk}\p{Cf}\p{No}\p{Me}\uFE0F]")
_ODD_RE2, _GAP_RE2 = r"[\p{So}\p{Sk}\p{Cf}\p{No}\p{Me}\x{FE0F}]+", r"[^\p{L}\p{M}]+"
_LETTER = re.compile(r"[^\W\d_]")
_WIDE = re.compile(r"[぀-ヿ㐀-鿿豈-﫿]")
#: Letters (wide ones count three times) that a line without an end mark needs to be a sentence and no phrase.
LINE = 12
#: Out-of-place distance, summed over a sentence's n-grams, by which a language must be nearer than those that the text is
#: known to have, to be one more; twice as much makes a language known.
EVIDENCE = 2_500
#: Characters of judged sentences that a task remembers at most.
REMEMBERED = 8_000_000
#: Pieces compared at once.
CHUNK = 1_000


def label_code(label: str | None) -> str | None:
    """The code of the language that a label names: a code, one with region or script, or a name; else None."""
    name = (label or "").strip().lower()
    return _CODE.get(name) or _CODE.get(re.split(r"[-_ ]", name)[0])


def without_front_matter(text: str) -> str:
    """Text with white space in place of a block between two ``---`` lines at its start in which all lines are entries.

    Emoji and the like within these lines don't matter.
    """
    first = _FIRST.search(text)
    if first is None or first.group() != "-":
        return text
    at, opened = 0, False
    for line in text.splitlines(keepends=True):
        at += len(line)
        bare = _ODD.sub("", line).strip()
        if bare == "---":
            if opened:
                return " " * at + text[at:]
            opened = True
        elif bare and not (opened and _ENTRY.match(bare)):
            break
    return text


def sentences(text: str) -> list[tuple[int, int, bool]]:
    """``(start, end, whole)`` of the pieces of a text that have letters.

    A piece of any length with an end mark is a whole sentence; headings aren't, nor are short lines without an end mark.
    """
    body, out, start = without_front_matter(text), [], 0
    for end in [*(m.end() for m in _END.finditer(body)), len(body)]:
        piece = body[start:end]
        if _LETTER.search(piece):
            bare = piece.lstrip()
            heading = "#" in bare[:9] and _ODD.sub("", bare).startswith("#")
            last = bare.rstrip()[-1]
            closed = last in _MARKS or last in _QUOTES and _CLOSED.search(bare) is not None
            whole = not heading and (closed or len(_LETTER.findall(bare)) + 2 * len(_WIDE.findall(bare)) >= LINE)
            out.append((end - len(bare), end, whole))
        start = end
    return out


class _Grams:
    """N-grams of the words of some pieces; ``_`` sets words off, no n-gram is across words.

    ``piece`` and ``word`` have an entry per word of a piece; n-grams and their weights are kept once per distinct word:
    those of word ``w`` are ``code[first[w]:first[w + 1]]``.
    """

    def __init__(self, pieces: list[str]) -> None:
        bare = pc.replace_substring_regex(pc.utf8_lower(pa.array(pieces, pa.string())), _ODD_RE2, "")
        lists = pc.split_pattern_regex(bare, _GAP_RE2)
        words = pc.list_flatten(lists)
        piece = pc.list_parent_indices(lists).to_numpy()
        filled = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
        coded = pc.dictionary_encode(words)
        self.piece, self.word = piece[filled].astype(np.int64), coded.indices.to_numpy()[filled].astype(np.int64)
        points = np.frombuffer("".join(f"_{w}_\0" for w in coded.dictionary.to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        end = points == 0
        owner = np.cumsum(end)
        gap = points == ord("_")
        wide = points >= 0x3040
        owners, codes, weights = [], [], []
        for n in range(1, ORDER + 1):
            stop = max(0, len(points) - n + 1)
            ok = np.ones(stop, bool)
            code = np.full(stop, n, np.int64)
            broad = np.zeros(stop, bool)
            for i in range(n):
                part = points[i : i + stop]
                ok &= ~end[i : i + stop]
                broad |= wide[i : i + stop]
                code = (code ^ part) * 0x5851F42D4C957F2D + (code >> 29)
            ok &= ~(gap[:stop] & gap[n - 1 : n - 1 + stop])
            owners.append(owner[:stop][ok])
            codes.append(code[ok])
            weights.append(np.where(broad[ok], WIDE_WEIGHT, 1))
        owner = np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        self.code, self.weight = np.concatenate(codes)[order], np.concatenate(weights)[order]
        self.first = np.searchsorted(owner[order], np.arange(len(coded.dictionary) + 1))

    def counts(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct n-grams of the words at ``tokens``, and how often they occur."""
        times = np.bincount(self.word[tokens], minlength=len(self.first) - 1)
        codes, place = np.unique(self.code, return_inverse=True)
        n = np.bincount(place, np.repeat(times, np.diff(self.first)), minlength=len(codes)).astype(np.int64)
        return codes[n > 0], n[n > 0]


def _spread(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges ``first[i]:last[i]``, one range after the other, and for each its ``i``."""
    sizes = last - first
    owner = np.repeat(np.arange(len(first)), sizes)
    return np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[owner], owner


class Profiles:
    """Ranks of the n-grams of each language; ``ranked`` has for each language its n-grams, most frequent first."""

    def __init__(self, ranked: dict[str, list[int]]) -> None:
        self.codes = np.unique(np.array([c for grams in ranked.values() for c in grams], np.int64))
        self.ranks = np.full((len(self.codes), len(LANGUAGES)), 3 * DEPTH, np.float32)  # beyond reach: not in the profile
        self.tables = []  # each has a place for every n-gram that found its place taken in the one before
        left = np.arange(len(self.codes))
        while len(left):
            table = np.full(1 << 16, -1, np.int32)
            place = self._place(self.codes[left], len(self.tables))
            table[place] = left
            self.tables.append(table)
            left = left[table[place] != left]
        for k, name in enumerate(LANGUAGES):
            self.ranks[np.searchsorted(self.codes, np.array(ranked[name], np.int64)), k] = np.arange(len(ranked[name]))

    @staticmethod
    def _place(codes: np.ndarray, n: int) -> np.ndarray:
        return codes >> (16 + 7 * (n % 5)) & 0xFFFF

    def _known(self, codes: np.ndarray) -> np.ndarray:
        """Place of each code among the profiles' n-grams, -1 if it is none of them."""
        found = self.tables[0][self._place(codes, 0)]
        found = np.where((found >= 0) & (self.codes[found] == codes), found, -1)
        for n, table in enumerate(self.tables[1:], 1):
            other = table[self._place(codes, n)]
            found = np.where((other >= 0) & (self.codes[other] == codes), other, found)
        return found

    def weighed(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Mean out-of-place distance of each piece to each language, and the sum of the weights that it is the mean of.

        N-grams of equal count share their mean rank. N-grams in no profile are equally far from all languages; they
        are counted once per distinct word instead of being compared.
        """
        if len(pieces) > CHUNK:  # what is worked on at once stays in the processor's cache
            parts = [self.weighed(pieces[at : at + CHUNK]) for at in range(0, len(pieces), CHUNK)]
            return np.concatenate([d for d, _ in parts]), np.concatenate([t for _, t in parts])
        n, out = len(pieces), np.full((len(pieces), len(LANGUAGES)), float(DEPTH))
        grams = _Grams(pieces)
        pairs, times = np.unique(grams.piece << 32 | grams.word, return_counts=True)
        piece, word = pairs >> 32, pairs & 0xFFFFFFFF
        at = self._known(grams.code)
        inside = at >= 0
        none = np.concatenate([[0], np.cumsum(grams.weight * ~inside)])
        outside = np.bincount(piece, (none[grams.first[1:]] - none[grams.first[:-1]])[word], minlength=n) if len(piece) else np.zeros(n)
        ends = np.concatenate([[0], np.cumsum(inside)])[grams.first]
        at, weight = at[inside], grams.weight[inside]
        where, token = _spread(ends[:-1][word], ends[1:][word])
        if not len(where):
            return out, outside
        # piece, n-gram, its weight (the same wherever it stands) and its count in one number
        own = pairs >> 32 << 40 | np.minimum(times, (1 << 20) - 1)
        code = np.sort(own[token] | (at[where] << 2 | weight[where]) << 20)
        count, code = code & (1 << 20) - 1, code >> 20
        starts = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        count = np.minimum(np.add.reduceat(count, starts), (1 << 20) - 1)
        code = code[starts]
        owner, at, weight = code >> 20, code >> 2 & (1 << 18) - 1, code & 3
        # rank of a count within its piece: those above it and half of its equals
        often = np.flatnonzero(count > 1)  # few; all others of a piece share one rank
        above = np.bincount(owner[often], minlength=n)
        rank = above[owner] + (np.bincount(owner, minlength=n) - above - 1)[owner] / 2
        tally = (owner[often] << 20) + ((1 << 20) - 1 - count[often])
        ordered = np.sort(tally)
        rank[often] = (np.searchsorted(ordered, tally) + np.searchsorted(ordered, tally, side="right") - 1) / 2 - np.searchsorted(ordered, owner[often] << 20)
        total = np.bincount(owner, weight, minlength=n) + outside
        bounds = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        gain = self.ranks[at]
        gain -= rank[:, None].astype(np.float32)
        np.abs(gain, out=gain)
        np.subtract(DEPTH, gain, out=gain)
        np.maximum(gain, 0, out=gain)
        gain *= weight[:, None].astype(np.float32)
        out[owner[bounds]] -= np.add.reduceat(gain, bounds, axis=0) / np.maximum(total[owner[bounds]], 1)[:, None]
        return out, total

    def distances(self, pieces: list[str]) -> np.ndarray:
        """Mean out-of-place distance of each piece to each language."""
        return self.weighed(pieces)[0]

    def judge(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest language and confidence from 0 to 1 for each piece."""
        d = self.distances(pieces)
        near = np.sort(d, axis=1)
        return d.argmin(axis=1), (near[:, 1] - near[:, 0]) / np.maximum(near[:, 1], 1e-9)


def _count(profiles: Profiles | None):
    """``lang, code, n`` of labelled documents: of whole documents, or of the sentences that ``profiles`` confirms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces, langs = [], []
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = [text[a:b] for a, b, whole in sentences(text) if whole]
                pieces += own
                langs += [LANGUAGES.index(label_code(label))] * len(own)
            if not pieces:
                continue
            lang = np.array(langs)
            if profiles is not None:
                lang = profiles.judge(pieces)[0]
            grams = _Grams(pieces)
            for k in np.unique(lang):
                codes, counts = grams.counts(lang[grams.piece] == k)
                yield pa.RecordBatch.from_arrays([pa.array([LANGUAGES[k]] * len(codes)), pa.array(codes), pa.array(counts)], names=["lang", "code", "n"])

    return run


def _ranked(rows: dict[str, dict[int, int]]) -> dict[str, list[int]]:
    out = {}
    for name in LANGUAGES:
        counts = dict(rows.get(name, {}))
        seed = _Grams([SEEDS[name]])
        for code, n in zip(*(x.tolist() for x in seed.counts(np.arange(len(seed.word))))):
            counts[code] = counts.get(code, 0) + n
        out[name] = sorted(counts, key=lambda c: (-counts[c], c))[:DEPTH]
    return out


def names_language(label: Column) -> Column:
    """Whether a label names one of the languages."""
    name = F.lower(F.trim(label))
    return name.isin(list(_CODE)) | F.split(name, "[-_ ]")[0].isin(list(_CODE))


def learn_profiles(
    documents: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    label: str = "lang",
    train: int = TRAIN,
    train_chars: int = TRAIN_CHARS,
) -> Profiles:
    """Profiles from labelled documents, those that hash lowest, and SEEDS: at most ``train``, and ``train_chars`` characters in all.

    Labels may be wrong: the first profiles judge the sentences of the sample again, and the second ones are made of
    the sentences as judged. Only the 2 DEPTH most frequent n-grams of each language reach the driver.
    """
    sample = documents.where(names_language(F.col(label)) & F.col(text).rlike(r"\p{L}")).select(
        F.col(label).alias("label"),
        F.col(text).alias("text"),
        F.col(key).alias("key"),
    )
    sample = durable(hash_sample(sample, "text", train, train_chars, documents.count()).repartition(16, "key").drop("key"))
    profiles = None
    for _ in range(2):
        counts = sample.mapInArrow(_count(profiles), "lang string, code bigint, n bigint").groupBy("lang", "code").agg(F.sum("n").alias("n"))
        place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))  # n-grams of the sample only
        best: dict[str, dict[int, int]] = {}
        for r in counts.withColumn("place", place).where(F.col("place") <= 2 * DEPTH).collect():
            best.setdefault(r["lang"], {})[r["code"]] = r["n"]
        profiles = Profiles(_ranked(best))
    return profiles


_SEGMENT = "array<struct<lang_code: string, confidence: double, char_start: int, char_end: int, n_sentences: int>>"
_SEGMENT_ARROW = pa.list_(
    pa.struct(
        [("lang_code", pa.string()), ("confidence", pa.float64()), ("char_start", pa.int32()), ("char_end", pa.int32()), ("n_sentences", pa.int32())]
    )
)


def _segments(spans: list[tuple[int, int, bool]], langs: list[int], sure: list[float]) -> list[dict]:
    """Neighbouring sentences of one language as one segment. Pieces that aren't whole go with the segment before."""
    if not any(whole for *_, whole in spans):
        spans = [(spans[0][0], spans[-1][1], False)] if spans else []
    out: list[dict] = []
    for (start, end, whole), lang, confidence in zip(spans, langs, sure):
        if out and (not whole or out[-1]["lang_code"] == LANGUAGES[lang]):
            last = out[-1]
            if whole:
                last["confidence"] = (last["confidence"] * last["n_sentences"] + confidence) / (last["n_sentences"] + 1)
                last["n_sentences"] += 1
            last["char_end"] = end
        elif whole or len(spans) == 1:
            out.append({"lang_code": LANGUAGES[lang], "confidence": confidence, "char_start": start, "char_end": end, "n_sentences": int(whole)})
    return out


def _decided(distance: np.ndarray, text: np.ndarray, counts: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Language and confidence of each piece from its summed distances, its text and whether it is a whole sentence.

    A text is known to have the language nearest to its sentences as a whole, and those that a sentence is nearest to
    by twice EVIDENCE. A piece is in the nearest of these, unless another is nearer by EVIDENCE: a sentence of a few
    letters, which says little by itself, so needs no length of its own to be judged.
    """
    rows, own = np.arange(len(text)), distance * counts[:, None]
    main = np.stack([np.bincount(text, own[:, k], minlength=n_texts) for k in range(len(LANGUAGES))], axis=1).argmin(axis=1)
    ordered = np.sort(distance, axis=1)
    best = distance.argmin(axis=1)
    known = np.zeros((n_texts, len(LANGUAGES)), bool)
    known[np.arange(n_texts), main] = True
    strong = counts & (ordered[:, 1] - ordered[:, 0] >= 2 * EVIDENCE)
    known[text[strong], best[strong]] = True
    near = np.where(known[text], distance, np.inf).argmin(axis=1)
    lang = np.where(distance[rows, near] - distance[rows, best] < EVIDENCE, near, best)
    rival = np.where(lang == best, ordered[:, 1], ordered[:, 0])
    return lang, np.clip((rival - distance[rows, lang]) / np.maximum(rival, 1e-9), 0, 1)


def _identify(profiles):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judged: dict[str, int] = {}  # sentences met before, by their row in the summed distances
        sums, held = np.empty((0, len(LANGUAGES))), 0
        for batch in batches:
            texts, labels = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            done = 0
            while done < len(texts):
                upto, chars = done, 0
                while upto < len(texts) and (upto == done or chars + len(texts[upto] or "") <= 2_000_000):
                    chars += len(texts[upto] or "")
                    upto += 1
                spans, pieces, counts = [], [], []
                for text in texts[done:upto]:
                    own = sentences(text) if text else []
                    spans.append(own)
                    whole = [w for *_, w in own]
                    # without a whole sentence, the whole text is judged at once
                    pieces += [text[a:b] for a, b, _ in own] if any(whole) else [text[own[0][0] : own[-1][1]]] if own else []
                    counts += whole if any(whole) else [True] * min(1, len(own))
                sizes = [len(own) if any(w for *_, w in own) else min(1, len(own)) for own in spans]
                if held > REMEMBERED:
                    judged.clear()
                    sums, held = sums[:0], 0
                new = list({p for p in pieces if p not in judged})
                if new:
                    mean, total = profiles.value.weighed(new)
                    judged.update(zip(new, range(len(sums), len(sums) + len(new))))
                    sums = np.concatenate([sums, mean * total[:, None]])
                    held += sum(map(len, new))
                found: list[list[dict]] = [[] for _ in spans]
                if pieces:
                    langs, sure = (
                        x.tolist() for x in _decided(
                            sums[np.fromiter(map(judged.__getitem__, pieces), np.int64, len(pieces))],
                            np.repeat(np.arange(len(spans)), sizes),
                            np.array(counts),
                            len(spans),
                        )
                    )
                    ends = np.cumsum(sizes).tolist()
                    found = [_segments(own, langs[end - size : end], sure[end - size : end]) for own, size, end in zip(spans, sizes, ends)]
                codes = [label_code(x) for x in labels[done:upto]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(done, upto - done), pa.array(codes, pa.string()), pa.array(found, _SEGMENT_ARROW)],
                    names=["key", "label_code", "segments"],
                )
                done = upto

    return run


def identify(documents: DataFrame, profiles: Profiles, *, key: str = "doc_id", text: str = "text", label: str = "lang") -> DataFrame:
    """``key, label_code, segments``: the language that the label names (or null) and the segments of the text in order.

    A segment has a language, a confidence from 0 to 1, its place in the text and its number of whole sentences. A
    text with letters but without a whole sentence (a heading, a word) is one segment with 0 sentences; one without
    letters, a null and an empty text have no segment. Texts are read whole. One row per input row, no shuffle.
    """
    rows = documents.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text"), F.col(label).alias("label"))
    out = widened(rows).mapInArrow(_identify(documents.sparkSession.sparkContext.broadcast(profiles)), f"key bigint, label_code string, segments {_SEGMENT}")
    return out.withColumnRenamed("key", key)


def main_languages(identified: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """``key, label_code, lang_code, confidence, n_segments``: one row per row of ``identified``.

    The language of most characters (of equal ones, the first in the text) with the mean confidence of its segments, by
    their length; both are null for a text without words, which has no segments.
    """
    size = lambda s: (s["char_end"] - s["char_start"]).cast("double")
    of = lambda code, value: F.aggregate(F.filter("segments", lambda s: s["lang_code"] == code), F.lit(0.0), lambda a, s: a + value(s))
    codes = F.array_distinct(F.transform("segments", lambda s: s["lang_code"]))
    sums = F.transform(
        codes,
        lambda c, i: F.struct(
            of(c, size).alias("chars"),
            (-i).alias("place"),
            c.alias("lang_code"),
            (of(c, lambda s: size(s) * s["confidence"]) / of(c, size)).alias("confidence"),
        ),
    )
    best = F.array_max(sums)
    return identified.select(
        key,
        "label_code",
        best["lang_code"].alias("lang_code"),
        best["confidence"].alias("confidence"),
        F.size("segments").alias("n_segments"),
    )


def mislabelled(identified: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """``key, lang_code``: a row per language of documents whose label is missing or wrong, or that mix languages."""
    langs = F.array_distinct(F.transform("segments", lambda s: s["lang_code"]))
    rows = identified.select(key, "label_code", langs.alias("langs")).where(F.size("langs") > 0)
    wrong = (F.size("langs") > 1) | F.col("label_code").isNull() | (F.col("label_code") != F.col("langs")[0])
    return rows.where(wrong).select(key, F.explode("langs").alias("lang_code"))
