"""Answers of a model that can't be used, with the type of defect.

Answers are cut into units: items and their sentences, numbers made alike. All distinct units are sorted and each is
compared with its next complete neighbour: a unit that is a beginning of it, and that never stands complete anywhere,
is a shortened version. Lengths at which open answers pile up show a length limit. Marks and connecting words settle
only what neither decides. The other defects are rules on one answer and its prompt: nothing said, a refusal, a copy of
the prompt, another language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkfold.llm.language import EVIDENCE, Profiles
from inkfold.session import durable

# Words that stand for no value, without case and marks; fixed values.
NO_VALUE = set("na none null nil nan undefined empty tbd 无 暂无 空 没有 无内容 なし 無し keine nichts aucun aucune rien ninguno ninguna nada nenhum nenhuma".split())
# How a model declines, by language, in its own voice; fixed values.
REFUSALS = regex.compile(
    "|".join(
        (
            r"作为(?:一个|一名)?(?:大型)?(?:AI|人工智能|语言)+(?:语言)?(?:模型|助手)?(?=[，,]|模型|助手)",
            r"我(?:确实|实在|暂时|目前|们)?(?:无法|没有办法|没办法|不能|没法|难以|不便|不方便)(?:对|就|替|为|给|向|协助|提供|完成|处理|回答|评价|评论|满足|作出|给出|生成|总结)|我.{0,6}(?:回答|处理|完成|评价|评论)不了|(?:请求|问题|要求)我(?:回答|处理|完成|满足)不了",
            r"不便由我|恕难|恕我(?:不能|无法)|我?不适合替您|请求.{0,6}(?:不予|无法)处理|安全策略|超出了?我.{0,8}范围|我只是一个(?:程序|模型)|另请高明|答不上来|(?:要|让)我替.{0,12}不合适",
            r"\bas an? (?:ai\b|(?:ai |large )?language model|ai assistant|program i\b)",
            r"\bi(?:'m| am)? (?:cannot|can't|can not|could not|couldn't|won't|will not|(?:am )?(?:unable|not able) to|would rather not|must decline|have to decline|hold no opinion)\b",
            r"\bi(?:'m| am) (?:unable|not able|not allowed|not in a position|not comfortable|not permitted)\b|not (?:be )?appropriate for me\b|not something i can\b|beyond what i (?:may|can)\b|against my (?:policy|guidelines)|generation (?:was|has been) stopped|restricted topic|content policy",
            r"\bals (?:ki[- ])?sprachmodell\b|\bals ki\b|\b(?:ist|wäre) es mir (?:leider )?nicht möglich|\b(?:darf|kann|möchte) ich (?:leider )?(?:keine|nicht|mich .{0,20}nicht|diese[nrs]? \w+ nicht)\b|\bich (?:kann|darf|möchte) (?:leider )?(?:keine|nicht|diese[nrs]? \w+ nicht|hierzu|dazu)\b|\bich bin (?:leider )?nicht (?:in der lage|befugt|berechtigt|imstande)",
            r"\bmodèle de lang(?:ue|age)\b|\ben tant qu'(?:ia|assistant)\b|\bje (?:ne |n')(?:peux|suis|saurais|puis|pourrai) pas\b|\bje ne saurais\b|\bil (?:ne |n')?m'est (?:impossible|pas possible)\b|\bje préfère ne pas\b",
            r"\bmodelo de lenguaje\b|\bcomo (?:una )?(?:ia|inteligencia artificial),|\bno (?:puedo|me es posible|estoy (?:en condiciones|autorizad[oa])|me corresponde|soy capaz)\b",
            r"\bmodelo de linguagem\b|\bcomo (?:uma )?(?:ia|inteligência artificial),|\bnão (?:posso|me é possível|tenho condições|estou (?:em condições|autorizad[oa])|me cabe|sou capaz|consigo (?:ajudar|responder|atender|analisar|avaliar))\b",
            r"言語モデル|AIとして|(?:お手伝い|評価|要約|回答|提供|対応|意見を述べる|コメント)(?:を)?(?:する)?(?:こと)?(?:は|が|には)?(?:できません|差し控え)|(?:お答え|お応え)(?:する(?:こと)?)?(?:は|が)?(?:こと(?:は|が))?できません|(?:いた|致)しかねます|コメント(?:は|を)差し控え",
        )
    ),
    regex.IGNORECASE,
)
# Words after which a sentence must go on, by language; fixed values.
GOING_ON = regex.compile(
    r"(?:以及|并且|而且|同时|从而|因此|因为|由于|所以|尤其是|其中|包括|例如|一是|但是|但|而|和|与|或|及|的|"
    r"\b(?:and|or|but|because|which|that|with|the|a|an|of|to|for|in|so|while|especially|including|especially in|of which|und|oder|aber|weil|die|der|das|dass|mit|davon|vor allem|et|ou|mais|car|qui|que|dont|avec|le|la|les|de|y|pero|porque|con|el|los|e|mas|com|o|os|do|da|para)|"
    r"また|そして|しかし|および|特に|なぜなら|うち)$",
    regex.IGNORECASE,
)
_CLOSED = r"[。！？!?.][”』」\"'»)）\]]*$"
_END = regex.compile(_CLOSED)
_DOTS = regex.compile(r"(?:…+|\.{2,}|。{2,})[”』」\"'»)）]*$")
_QUOTED = regex.compile(r"“[^”]*(?:”|$)|«[^»]*(?:»|$)|「[^」]*(?:」|$)|『[^』]*(?:』|$)|《[^》]*(?:》|$)|\"[^\"]*\"|‘[^’]*’")
_MARKS = regex.compile(r"[^\p{L}\p{N}]+")
_NUMBER = regex.compile(r"\d+(?:[.,]\d+)*")
_SPACE = regex.compile(r"\s+")
_SENTENCE = regex.compile(r"(?<=[。！？!?][”』」\"'»)）\]]*)(?![”』」\"'»)）\]。！？!?])|(?<=\.)\s+|\n+")
_PART = regex.compile(r"[\n。！？.!?：:]+")
_WIDE = regex.compile(r"[぀-ヿ㐀-鿿]")
_CUT_NUMBER = regex.compile(r"[぀-ヿ㐀-鿿].*#\.$")


def unit(text: str) -> str:
    """A unit in the form in which units are compared: lower case, one blank for white space, numbers as ``#``."""
    return _SPACE.sub(" ", _NUMBER.sub("#", text.lower())).strip()


def _bare(text: str) -> str:
    return _MARKS.sub("", text.casefold())


def items_of(answer: list[str | None]) -> list[str]:
    """The items that say something."""
    return [x for x in answer if x is not None and (b := _bare(x)) and b not in NO_VALUE]


def units_of(items: list[str]) -> tuple[list[str], str | None]:
    """Units of an answer, and its last one if that has no end mark (else None)."""
    units = [u for item in items for s in _SENTENCE.split(item) if s and (u := unit(s))]
    return units, units[-1] if units and (not _END.search(units[-1]) or _CUT_NUMBER.search(units[-1])) else None


def copied(items: list[str], whole: str) -> bool:
    """Whether every part of the answer is a part of the prompt, but for case, white space and marks; ``whole`` is the bare prompt."""
    return all(_bare(x) in whole or all(_bare(p) in whole for p in _PART.split(x)) for x in items)


def _rules(profiles):
    """Per answer: a defect that one answer and its prompt show, or what is needed to tell whether it is truncated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, fields, answers, prompts = (batch.column(k).to_pylist() for k in range(4))
            n = len(keys)
            defects: list[str | None] = [None] * n
            kept = [items_of(a or []) for a in answers]
            wholes = {p: _bare(p) for p in set(prompts) if p}
            ask: list[int] = []
            for i in range(n):
                if not kept[i]:
                    defects[i] = "empty"
                elif any(REFUSALS.search(_QUOTED.sub("", x)) for x in kept[i]):
                    defects[i] = "refusal"
                elif prompts[i] and copied(kept[i], wholes[prompts[i]]):
                    defects[i] = "copied"
                elif prompts[i]:
                    ask.append(i)
            if ask:
                spoken = [_QUOTED.sub(" ", "\n".join(kept[i])) for i in ask]
                asked, langs = {}, profiles.value
                for p in dict.fromkeys(prompts[i] for i in ask):
                    asked[p] = len(asked)
                mean, total = langs.weighed(spoken)
                own, order = mean.argmin(axis=1), np.sort(mean, axis=1)
                away = langs.distances(list(asked))
                near = away.argsort(axis=1)
                rows = range(len(asked))
                # a prompt that is as near to a second language may be answered in either
                mixed = away[rows, near[:, 1]] <= away[rows, near[:, 0]] * (1 + SURE)
                for k, i in enumerate(ask):
                    p = asked[prompts[i]]
                    meant = {near[p, 0], near[p, 1]} if mixed[p] else {near[p, 0]}
                    ahead = (min(mean[k, m] for m in meant) - order[k, 0]) * total[k]
                    if own[k] not in meant and order[k, 1] - order[k, 0] > SURE * order[k, 1] and ahead >= EVIDENCE:
                        defects[i] = "other_language"
            tails: list[str | None] = [None] * n
            units: list[list[str]] = [[]] * n
            marks, styles = [False] * n, [False] * n
            for i in range(n):
                units[i], tails[i] = units_of(kept[i])
                if defects[i]:
                    continue
                tail, last = tails[i], kept[i][-1].strip()
                marks[i] = bool(_DOTS.search(last) or tail and (fields[i] in PROSE or tail[-1] in ",，、;；:：-—(（[「『《“"))
                styles[i] = tail is not None and bool(GOING_ON.search(tail) or any(_END.search(x.strip()) for x in kept[i][:-1]))
            sizes = [sum(len(x) for x in a or [] if x) for a in answers]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(defects, pa.string()),
                    pa.array(tails, pa.string()),
                    pa.array(marks, pa.bool_()),
                    pa.array(styles, pa.bool_()),
                    pa.array(sizes, pa.int64()),
                    pa.array(units, pa.list_(pa.string())),
                ],
                names=["key", "field_name", "defect", "tail", "mark", "style", "size", "units"],
            )

    return run


#: Least confidence at which another language counts.
SURE = 0.05
#: Fields whose answers are sentences, which end with a mark.
PROSE = ("market_view",)
_RULED = "key bigint, field_name string, defect string, tail string, mark boolean, style boolean, size bigint, units array<string>"


def count_units(answers: DataFrame) -> DataFrame:
    """``unit, ending, n_open, n_other`` from ``units, tail``: how often a unit ends an answer without an end mark, and elsewhere.

    ``ending`` is the last four letters of a unit in a wide script, the last two words of another, null after an end mark.
    """
    split = answers.select(F.posexplode("units").alias("at", "unit"), F.size("units").alias("n"), F.col("tail").isNotNull().alias("has_tail"))
    is_open = F.col("has_tail") & (F.col("at") + 1 == F.col("n"))
    counts = split.groupBy("unit").agg(F.count_if(is_open).alias("n_open"), F.count_if(~is_open).alias("n_other"))
    last = F.when(F.right("unit", F.lit(1)).rlike(_WIDE.pattern), F.right("unit", F.lit(4))).otherwise(F.substring_index("unit", " ", -2))
    return counts.select("unit", F.when(~F.col("unit").rlike(_CLOSED), last).alias("ending"), "n_open", "n_other")


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Units in falling order to the open ones, each with whether the next complete unit begins with it.

    Where a task has no complete unit after an open one, that is left null; the task's lowest complete unit is told, for
    the task before.
    """
    after: str | None = None
    part = None
    out: list[tuple] = []

    def passed():
        batch = pa.RecordBatch.from_arrays(
            [pa.array([o[k] for o in out], t) for k, t in enumerate((pa.string(), pa.bool_(), pa.bool_(), pa.int32()))],
            names=["unit", "shortened", "lowest", "part"],
        )
        out.clear()
        return batch

    for batch in batches:
        for unit, is_open, is_complete, part in zip(*(batch.column(k).to_pylist() for k in range(4))):
            if is_open:
                out.append((unit, None if after is None else after.startswith(unit), False, part))
            if is_complete:
                after = unit
        yield passed()
    if after is not None:
        out.append((after, None, True, part))
        yield passed()


def open_units(answers: DataFrame) -> DataFrame:
    """``tail, complete, shortened`` of every unit that ends an answer without an end mark.

    ``complete``: it also stands before the end of an answer, or ends as a unit without an end mark does there; items
    that are no sentences need no mark. ``shortened``: it is a beginning of a unit that stands complete. In sorted
    order it is one of any such unit exactly if it is one of the next; one unit of each task goes through the driver.
    ``answers`` has ``units``, and ``tail`` where the last of them has no end mark.
    """
    spark = answers.sparkSession
    counts = durable(count_units(answers))
    stands = (F.col("n_other") > 0) | F.col("ending").isNull()
    placed = counts.select(
        "unit",
        (F.col("n_open") > 0).alias("is_open"),
        stands.alias("is_complete"),
    ).repartitionByRange("unit").sortWithinPartitions(F.desc("unit")).withColumn("part", F.spark_partition_id())
    told = durable(placed.mapInArrow(_neighbours, "unit string, shortened boolean, lowest boolean, part int"))
    lowest, following = {r["part"]: r["unit"] for r in told.where("lowest").collect()}, []  # one row a task
    for part in range(max(lowest, default=-1), -1, -1):
        following.append((part - 1, lowest.get(part, following[-1][1] if following else None)))
    later = F.broadcast(spark.createDataFrame(following, "part int, next string"))  # one row a task
    shortened = told.where("not lowest").join(later, "part", "left").select(
        "unit",
        F.coalesce("shortened", F.startswith("next", "unit"), F.lit(False)).alias("shortened"),
    )
    endings = counts.where((F.col("n_other") > 0) & F.col("ending").isNotNull()).select("ending").distinct().withColumn("usual", F.lit(True))
    tails = counts.where(F.col("n_open") > 0).join(endings, "ending", "left").join(shortened, "unit")
    complete = (F.col("n_other") > 0) | F.coalesce("usual", F.lit(False))
    return tails.select(F.col("unit").alias("tail"), complete.alias("complete"), "shortened")


def length_limits(tails: DataFrame, *, times: float = 5.0, sigmas: float = 6.0) -> DataFrame:
    """``field_name, size``: lengths at which the different ``tails`` of a field pile up.

    Their number is at least ``times`` the mean over the ten lengths around, and above it by ``sigmas`` times the
    deviation that chance gives (the root of the mean, of 1 at least).
    """
    sizes = tails.groupBy("field_name", "size").agg(F.count_distinct("tail").alias("n"))
    near = Window.partitionBy("field_name").orderBy("size").rangeBetween(-5, 5)  # one row a length
    around = sizes.withColumn("around", (F.sum("n").over(near) - F.col("n")) / 10)
    spike = (F.col("n") >= times * F.col("around")) & (F.col("n") - F.col("around") >= sigmas * F.sqrt(F.greatest("around", F.lit(1))))
    return around.where(spike).select("field_name", "size")


def answer_defects(results: DataFrame, prompts: DataFrame, profiles: Profiles) -> DataFrame:
    """``result_id, field_name, defect, evidence`` of each answer in ``key_points`` and ``market_view`` that can't be used.

    ``defect`` is the first that holds of ``empty, refusal, copied, other_language, truncated``. ``evidence`` of a
    truncated answer is the first that holds: ``neighbour`` (its last unit is a beginning of its next complete
    neighbour and stands complete nowhere), ``limit`` (it isn't complete and as long as many that aren't), ``mark`` (it
    ends in dots or an opening mark, or is prose without an end mark), ``style`` (it isn't complete and ends in a word
    after which it must go on, or its other items have end marks); else it is ``rule``.

    An answer without a prompt can't be copied or in another language. If a prompt id is repeated, the prompt that
    sorts first counts. Empty tables give no rows; columns beyond those used are ignored.
    """
    spark = results.sparkSession
    fields = F.array(
        F.struct(F.lit("key_points").alias("field_name"), F.col("key_points").alias("items")),
        F.struct(F.lit("market_view").alias("field_name"), F.array("market_view").alias("items")),
    )
    known = prompts.groupBy("prompt_id").agg(F.min("prompt").alias("prompt"))
    joined = results.select("result_id", "prompt_id", fields.alias("fields")).join(known, "prompt_id", "left")
    answers = joined.select("result_id", F.explode("fields").alias("a"), "prompt").select("result_id", "a.field_name", "a.items", "prompt")
    ruled = durable(answers.mapInArrow(_rules(spark.sparkContext.broadcast(profiles)), _RULED))
    units = open_units(ruled.select("units", "tail"))
    open_rows = ruled.where(F.col("defect").isNull() & F.col("tail").isNotNull()).select("key", "field_name", "tail", "mark", "style", "size")
    judged = durable(open_rows.join(units, "tail", "left"))
    unfinished = ~F.coalesce("complete", F.lit(False))
    limits = length_limits(judged.where(unfinished)).withColumn("limit", F.lit(True))
    evidence = (
        F.when(unfinished & F.coalesce("shortened", F.lit(False)), "neighbour")
        .when(unfinished & F.coalesce("limit", F.lit(False)), "limit")
        .when(F.col("mark"), "mark")
        .when(unfinished & F.col("style"), "style")
    )
    cut = judged.join(F.broadcast(limits), ["field_name", "size"], "left").select(
        "key",
        "field_name",
        F.lit("truncated").alias("defect"),
        evidence.alias("evidence"),
    )  # limits: a few lengths
    told = ruled.where(F.col("defect").isNotNull() | (F.col("tail").isNull() & F.col("mark")))
    told = told.select(
        "key",
        "field_name",
        F.coalesce("defect", F.lit("truncated")).alias("defect"),
        F.when(F.col("defect").isNull(), "mark").otherwise("rule").alias("evidence"),
    )
    return told.unionByName(cut.where(F.col("evidence").isNotNull())).withColumnRenamed("key", "result_id")


def broken_answers(results: DataFrame, prompts: DataFrame, profiles: Profiles) -> DataFrame:
    """``answer_defects`` without the evidence."""
    return answer_defects(results, prompts, profiles).drop("evidence")
