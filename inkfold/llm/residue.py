"""Fields that hold template residue, filler, error pages or script notices in place of an author's words.

Two naive Bayes classifiers learn from trusted positives and unlabelled data by expectation-maximization: one for the
passages of texts, one for slots, the bracketed spans in which templates keep their place-holders. The passages of a
field are scored and weighed against each other; a slot counts by itself, also inside real text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkfold.operators.sampling import hash_sample
from inkfold.session import widened

# What passages say that are certainly residue, one pattern a line; fixed values.
TRUSTED_PATTERNS = (
    r"^(?:loading(?: content)?|just a moment|attention required|access denied)[\s.…!]*$",
    r"^(?:error \d{3}|(?:4\d\d|5\d\d) (?:not found|bad gateway|forbidden|internal server error|service unavailable|gateway time-?out)|page not found)[\s.!]*$",
    r"^(?:加载中|正文加载中|安全验证|页面不存在|提示信息.{0,8})[\s.…!。！]*$",
    r"^(?:untitled|示例标题|待补充|测试(?:测试)*)[\s.…!。！]*$",
    r"\b(?:enable|activate|turn on|aktivieren sie|activer|active|habilite|activar?|ativar?) (?:the )?(?:javascript|cookies)",
    r"javascript (?:is )?(?:disabled|required)|javascript を有効|请启用 ?javascript",
    r"(?:启用|开启|打开|禁用了?|关闭) ?(?:了)?(?:javascript|js|脚本).{0,24}(?:继续|刷新|查看|访问|无法|加载)|依赖脚本运行|scripts and cookies must",
    r"(?:seite|page|página|address).{0,24}(?:nicht gefunden|was not found|not found on this server|introuvable|no encontrada|não encontrada)",
    r"(?:地址|页面|内容|文章|记事|お探しの記事).{0,24}(?:不存在|走丢了|已被删除|移動または削除)|ページが見つかりません",
    r"服务器开小差|系统繁忙|内容加载失败|访问过于频繁|数据库连接失败|too many connections",
    r"temporarily unavailable|checking your browser|upstream timed out|^traceback\b|une erreur est survenue|site owner",
    r"\blorem\b.*\b(?:dolor|amet|ipsum)|\bdolor\b.*\blorem|\bipsum\b.*\blorem",
    r"\bblindtext\b.*\bblindtext|\bsample text\b|\bplaceholder text\b|^todo\b",
    r"请替换为|此处填写|请在此输入|请在此填写|此处为示例|正文占位|稍后补上|待编辑填写",
)
TRUSTED = regex.compile("|".join(TRUSTED_PATTERNS), regex.IGNORECASE)
_REPEATED = regex.compile(r"(\p{L}[^\n]{1,11}?)\1{2,}")
# Texts of the same kind, so that a classifier exists where a table holds none; fixed values.
EXAMPLES = (
    "404 Not Found The requested page was not found on this server.",
    "502 Bad Gateway upstream timed out",
    "Access denied. Reference number 1. If you believe this is a mistake, contact the site owner.",
    "You need to enable JavaScript to view this page.",
    "JavaScript is disabled in your browser. Turn it on and reload the page.",
    "Checking your browser before access... scripts and cookies must be allowed.",
    "Service temporarily unavailable. Please try again in a few minutes.",
    "请在浏览器中启用 JavaScript 后继续访问。",
    "您访问的页面不存在或已被删除，几秒后返回首页",
    "系统繁忙，请稍后再试（错误码：1）",
    "访问过于频繁，您的请求已被拦截，请完成验证后继续浏览。",
    "Bitte aktivieren Sie JavaScript, um diesen Inhalt zu sehen.",
    "Seite nicht gefunden. Bitte prüfen Sie die Adresse.",
    "Veuillez activer JavaScript dans votre navigateur pour lire cet article.",
    "Une erreur est survenue : page introuvable. Retour à l'accueil",
    "Habilite JavaScript en su navegador para ver este contenido.",
    "Página no encontrada.",
    "Ative o JavaScript no seu navegador para ver este conteúdo.",
    "Página não encontrada.",
    "このページを表示するには JavaScript を有効にしてください。",
    "ページが見つかりません。お探しの記事は移動または削除されました。",
    "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor.",
    "TODO: write the body",
    "这里是文章正文，请替换为实际内容。",
    "Loading…",
    "正文加载中…",
    "此处填写标题",
)
#: Fields and characters of the sample that the classifiers learn from at most; rounds of expectation-maximization.
TRAIN_FIELDS, TRAIN_CHARS, ROUNDS = 20_000, 4_000_000, 6
#: Share of the background in each class's word distribution; buckets of hashed words.
SMOOTH, BUCKETS = 0.02, 1 << 18
#: Characters that are judged at once, or one longer text.
AT_ONCE = 500_000

_HEADING = regex.compile(r"\A\s*#[^\n]*(?:\n|\Z)")
_PASSAGE = regex.compile(r"[\n。！？!?…]+|\.(?=\s|$)")
# Bracketed spans of any length. Each form ends at its own next bracket, so a text is read once.
_SLOT = regex.compile(
    r"\{\{[^{}]+\}\}|[$#]\{[^{}]+\}|\{%[^{}]+%\}|<%[^<>]+%>|<!--[^<>]+-->|%\([^()]+\)[sdf]|@@[^@]+@@|(?<![\w_])__[^_\s](?:[^\n_]|_(?!_))*__(?![\w_])|\[\[[^\[\]]+\]\]|"
    r"\$[^\W\d][\w.]*\$|\{[^{}\n]+\}|\[[^\[\]\n]+\](?!\()|<[^<>\n]+>|【[^【】\n]+】|«[^«»\n]+»"
)
_TRUSTED_SLOT = regex.compile(
    r"\{\{.*\}\}|[$#]\{.*\}|\{%.*%\}|<%.*%>|<!--.*(?:here|placeholder|todo).*-->|%\(.*\)[sdf]|@@.*@@|__.*__|\[\[.*\]\]|\[insert\b.*\]|\[your\b.*\]|[\[【<].*(?:在此输入|在此填写|您的|你的).*[\]】>]|«.*(?:einfügen|insérer|insert|insertar|inserir).*»",
    regex.IGNORECASE | regex.DOTALL,
)
_OPENERS = "{[<【«@_$%"
_WORD = regex.compile(r"[^\W_]+")
_NAME = regex.compile(r"[\w.]+")
_INSIDE = regex.compile(r"[^\W_](?:.*[^\W_])?", regex.DOTALL)
_LETTER = regex.compile(r"\p{L}")
_BASE = np.uint64(0x9E3779B97F4A7C15)


def content(text: str) -> str:
    """The text without a heading line at its start; the whole text if there is nothing else."""
    rest = _HEADING.sub("", text, count=1)
    return rest if _LETTER.search(rest) else text


def prose(text: str) -> str:
    """The content without place-holders of the trusted forms, which are judged by themselves."""
    text = content(text)
    return _SLOT.sub(lambda m: " " if _TRUSTED_SLOT.fullmatch(m.group()) else m.group(), text) if any(c in text for c in _OPENERS) else text


def trusted(text: str, pattern: regex.Pattern = TRUSTED) -> bool:
    """Whether a text is residue for certain: half of its letters or more are in passages that say so, or it is one short string again and again."""
    text = content(text).strip()
    if _REPEATED.fullmatch(text) or _REPEATED.fullmatch(text + " "):
        return True
    said = [(len(_LETTER.findall(p)), p.strip()) for p in _PASSAGE.split(text)]
    return 0 < 2 * sum(n for n, p in said if n and pattern.search(p)) >= sum(n for n, _ in said)


def trusted_slot(slot: str) -> bool:
    return bool(_TRUSTED_SLOT.fullmatch(slot))


def slots(text: str) -> list[str]:
    """Bracketed spans that may be place-holders."""
    return [m.group() for m in _SLOT.finditer(text)]


def _slot_features(slot: str) -> list[str]:
    """The slot's brackets, its words, the first and last with the brackets; of a slot that is one name, that and its pairs of letters."""
    inner = slot.strip("{}[]<>【】«»$#%@_!-=() ").lower()
    words = _WORD.findall(inner)
    form = _INSIDE.sub(" ", slot)
    edges = [f"{form} {words[0]}", f"{words[-1]} {form}"] if words else []
    name = ["name " + inner, *("".join(p) for p in zip(inner, inner[1:]))] if _NAME.fullmatch(inner) else []
    return ["form " + form, *edges, *words, *name]


class _Words:
    """Words of texts as bucket numbers: whole words of alphabetic scripts, neighbouring words, pairs of wide letters, a passage's first and last."""

    _kind = np.zeros(0x110000, np.uint8)  # 1 letter, 2 wide letter, 3 digit, 4 end of a passage
    _kind[[c for c in range(0x3040) if chr(c).isalpha()]] = 1
    _kind[0x3040:0xA000] = 2
    _kind[0xAC00:0xD7A4] = 2
    _kind[0xF900:0xFB00] = 2
    _kind[[ord(c) for c in "0123456789"]] = 3
    _kind[[ord(c) for c in "\0\n。！？!?…"]] = 4

    def __init__(self, texts: list[str]) -> None:
        """``bucket``, ``passage`` and ``size`` (letters) of each feature; ``field`` of each passage."""
        points = np.frombuffer("\0".join(t.lower() for t in [*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = self._kind[points]
        kind[(points == ord(".")) & (np.append(points[1:], 32) <= 32)] = 4
        ends = kind == 4
        passage = np.cumsum(ends) - ends
        self.field = np.zeros(int(passage[-1]) + 1 if len(passage) else 0, np.int64)
        self.field[passage] = np.cumsum(points == 0) - (points == 0)
        before = np.concatenate([[0], kind[:-1]])
        start = np.flatnonzero(((kind == 1) & (before != 1)) | (kind == 2) | ((kind == 3) & (before != 3)))
        follow = np.append(kind[1:], 4)
        stop = np.flatnonzero(((kind == 1) & (follow != 1)) | (kind == 2) | ((kind == 3) & (follow != 3)))
        # hash of a run of letters from prefix sums of a polynomial
        power = np.cumprod(np.full(len(points) + 1, _BASE, np.uint64))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(points.astype(np.uint64) * power[: len(points)])])
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        back = np.cumprod(np.full(len(points) + 1, inverse, np.uint64))
        token = (sums[stop + 1] - sums[start]) * back[start]
        token[kind[start] == 3] = 7
        token ^= token >> np.uint64(29)
        size = np.where(kind[start] == 3, 0, stop - start + 1)
        owner = passage[start]
        single = kind[start] == 1
        next_to = np.flatnonzero((owner[1:] == owner[:-1]) & (start[1:] - stop[:-1] <= 3))
        pair = token[next_to] * np.uint64(0xC2B2AE3D27D4EB4F) ^ token[next_to + 1]
        pair ^= pair >> np.uint64(31)
        edge = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.array([], np.int64)
        last = np.append(edge[1:] - 1, len(owner) - 1) if len(owner) else edge
        mixed = np.concatenate(
            [token[single], pair, token[edge] ^ np.uint64(0x5851F42D4C957F2D), token[last] ^ np.uint64(0x14057B7EF767814F)]
        ) * np.uint64(0xD6E8FEB86659FD93)
        self.bucket = (mixed >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)
        self.passage = np.concatenate([owner[single], owner[next_to], owner[edge], owner[last]])
        self.letters = np.bincount(owner, size, minlength=len(self.field))


def _log_odds(positive: np.ndarray, negative: np.ndarray) -> np.ndarray:
    """Per bucket; each class's distribution is mixed with the background, so that what is new to both says nothing."""
    background = (positive + negative) / max((positive + negative).sum(), 1e-9)
    one = (1 - SMOOTH) * positive / max(positive.sum(), 1e-9) + SMOOTH * background
    other = (1 - SMOOTH) * negative / max(negative.sum(), 1e-9) + SMOOTH * background
    return np.log(np.maximum(one, 1e-12) / np.maximum(other, 1e-12)) * (background > 0)


def learn(bucket: np.ndarray, unit: np.ndarray, trusted: np.ndarray, buckets: int, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Log-odds per bucket and prior log-odds from units of which some are trusted positives, the others unlabelled.

    Unlabelled units begin as negatives. Each round scores them and counts them by their probability; trusted units
    stay positive.
    """
    n = len(trusted)
    belief = trusted.astype(float)
    odds, prior = np.zeros(buckets), 0.0
    for _ in range(rounds):
        weight = belief[unit]
        odds = _log_odds(np.bincount(bucket, weight, minlength=buckets), np.bincount(bucket, 1 - weight, minlength=buckets))
        share = min(max(belief.mean(), 1e-4), 0.5)
        prior = float(np.log(share / (1 - share)))
        score = np.bincount(unit, odds[bucket], minlength=n) + prior
        belief = np.where(trusted, 1.0, 1 / (1 + np.exp(-np.clip(score, -50, 50))))
    return odds, prior


class ResidueModel:
    """Classifiers of passages and of slots, learned from a sample of fields."""

    def __init__(self, texts: list[str], trust: Callable[[str], bool] = trusted, trust_slot: Callable[[str], bool] = trusted_slot) -> None:
        """``trust`` and ``trust_slot`` say what is residue for certain; EXAMPLES they don't know are left out."""
        bodies = [*EXAMPLES, *map(prose, texts)] if trust is trusted else [*filter(trust, EXAMPLES), *map(prose, texts)]
        words = _Words(bodies)
        sure = np.array([*map(trust, bodies), False])
        if trust is trusted:
            sure[: len(EXAMPLES)] = True
        self.odds, self.prior = learn(words.bucket, words.passage, sure[words.field], BUCKETS)
        self.odds = self.odds.astype(np.float32)
        found = ["{{title}}", *(s for t in texts for s in slots(t))]
        names: dict[str, int] = {}
        pairs = [(names.setdefault(f, len(names)), i) for i, s in enumerate(found) for f in _slot_features(s)]
        odds, self.slot_prior = learn(np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]), np.array([*map(trust_slot, found)]), len(names))
        self.slot_odds = {name: float(odds[i]) for name, i in names.items()}

    def slot_score(self, slot: str) -> float:
        return self.slot_prior + sum(self.slot_odds.get(f, 0.0) for f in _slot_features(slot))

    def text_scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log-odds of each text, and the share of its letters that is in passages more likely residue than not."""
        words = _Words(list(map(prose, texts)))
        n = len(words.field)
        score = np.bincount(words.passage, self.odds[words.bucket], minlength=n)
        total = np.bincount(words.field, score, minlength=len(texts) + 1)[: len(texts)]
        letters = np.bincount(words.field, words.letters, minlength=len(texts) + 1)[: len(texts)]
        residue = np.bincount(words.field, words.letters * (score > 0), minlength=len(texts) + 1)[: len(texts)]
        return total + self.prior, np.where(letters > 1, residue / np.maximum(letters, 1), 0)  # one letter says nothing

    def judge(self, texts: list[str]) -> list[tuple[float, float, float]]:
        """Log-odds of the text, share of residue, and the log-odds of its likeliest slot (-inf without slots)."""
        total, share = self.text_scores(texts)
        best = [max(map(self.slot_score, slots(t)), default=float("-inf")) if any(c in t for c in _OPENERS) else float("-inf") for t in texts]
        return list(zip(total.tolist(), share.tolist(), best))


def _fields(df: DataFrame, key: str, fields: tuple[str, ...]) -> DataFrame:
    pairs = F.array(*(F.struct(F.lit(f).alias("field_name"), F.col(f).alias("text")) for f in fields))
    return df.select(
        F.col(key).cast("bigint").alias("key"),
        F.explode(pairs).alias("p"),
    ).select("key", "p.field_name", "p.text").where(F.col("text").rlike(r"\S"))


def learn_model(
    df: DataFrame,
    *,
    key: str = "post_row",
    fields: tuple[str, ...] = ("title", "body"),
    train_fields: int = TRAIN_FIELDS,
    train_chars: int = TRAIN_CHARS,
) -> ResidueModel:
    """A model from the fields that hash lowest: at most ``train_fields``, and ``train_chars`` characters in all."""
    sample = hash_sample(_fields(df, key, fields), "text", train_fields, train_chars, df.count() * len(fields))
    return ResidueModel([r["text"] for r in sample.orderBy("key", "field_name").collect()])  # within both bounds


def _judged(model: ResidueModel, texts: list[str]) -> list[tuple[float, float, float]]:
    """``model.judge`` of any number of texts, so many characters at once."""
    out, group, chars = [], [], 0
    for text in texts:
        if group and chars + len(text) > AT_ONCE:
            out += model.judge(group)
            group, chars = [], 0
        group.append(text)
        chars += len(text)
    return out + model.judge(group) if group else out


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            judged = _judged(model.value, batch.column(2).to_pylist())
            scores = [pa.array([j[k] for j in judged], pa.float64()) for k in range(3)]
            names = ["key", "field_name", "score", "share", "slot_score"]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *scores], names=names)

    return run


def _clean(model, fields: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            for k, name in enumerate(batch.schema.names):
                if name in fields:
                    texts = columns[k].to_pylist()
                    said = [i for i, t in enumerate(texts) if t and not t.isspace()]
                    for i, scores in zip(said, _judged(model.value, [texts[i] for i in said])):
                        if residue(*scores):
                            texts[i] = None
                    columns[k] = pa.array(texts, columns[k].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return run


def residue_scores(df: DataFrame, model: ResidueModel, *, key: str = "post_row", fields: tuple[str, ...] = ("title", "body")) -> DataFrame:
    """``key, field_name, score, share, slot_score`` of every field with other than white space; texts are read whole.

    Null, empty and blank fields give no row. No shuffle but for tables of few files.
    """
    broadcast = df.sparkSession.sparkContext.broadcast(model)
    return _fields(widened(df.select(key, *fields)), key, fields).mapInArrow(
        _score(broadcast),
        "key bigint, field_name string, score double, share double, slot_score double",
    ).withColumnRenamed("key", key)


def residue(score: float, share: float, slot_score: float) -> bool:
    """A likely slot, or a text that is as a whole, and for the greater part of its passages, likely residue."""
    return slot_score > 0 or (score > 0 and share >= 0.5)


def is_residue() -> Column:
    """``residue`` of a row of ``residue_scores``."""
    return (F.col("slot_score") > 0) | ((F.col("score") > 0) & (F.col("share") >= 0.5))


def without_residue(df: DataFrame, model: ResidueModel, *, fields: tuple[str, ...] = ("title", "body")) -> DataFrame:
    """``df`` with its ``fields`` that are residue set to null, in one pass; rows and other columns stay as they are.

    Blank, empty and null fields stay. No shuffle but for tables of few files.
    """
    return widened(df).mapInArrow(_clean(df.sparkSession.sparkContext.broadcast(model), fields), df.schema)
