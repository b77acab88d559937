import random
from pathlib import Path

import pytest
import regex
from pyspark.sql import functions as F

from inkfold.llm import answers, language, residue

ZH = ["今天市场有所上涨，因为大家都在等消息。", "我的看法是先等一等，不要着急。", "成交额比前一天少了一截，这个时候要看仓位。"]
EN = [
    "The market went up today because everyone waits for the news.",
    "My view is that it is better to wait and not to hurry.",
    "Turnover was lower than on the day before, so watch the size.",
]
DE = ["Der Markt ist heute gestiegen, weil alle auf Nachrichten warten.", "Meine Ansicht ist, dass es besser ist zu warten."]
ES = ["El mercado subió hoy porque todos esperan las noticias.", "Mi opinión es que es mejor esperar y no tener prisa."]
PT = ["O mercado subiu hoje porque todos esperam as notícias.", "A minha opinião é que é melhor esperar e não ter pressa."]
FR = ["Le marché est monté aujourd'hui parce que tout le monde attend les nouvelles.", "Mon avis est qu'il vaut mieux attendre et ne pas se presser."]
JA = ["今日は市場が上がりました、みんながニュースを待っているからです。", "私の考えは、急がずに待つのがよいということです。"]


@pytest.fixture(scope="module")
def profiles():
    return language.Profiles(language._ranked({}))


DOCUMENT = "doc_id bigint, text string, lang string"


def test_labels():
    assert [
        language.label_code(x) for x in ("zh_Hans", "ZH", "中文", "English", "en-GB", "por", "und", " ", None, "日本語", "xx", "??", "N/A")
    ] == ["zh", "zh", "zh", "en", "en", "pt", None, None, None, "ja", None, None, None]


def test_sentences():
    found = lambda t: [(t[a:b].strip(), w) for a, b, w in language.sentences(t)]
    assert found("# Title here\n\nThe index is at 3.5 today. \"So it is.\" 12 / 13\n") == [
        ("# Title here", False),
        ("The index is at 3.5 today.", True),
        ('"So it is."', True),
    ]
    assert found("---\nauthor_uid: 1\ntags: []\n---😂\n\n" + ZH[0]) == [(ZH[0], True)]
    assert found("---\nauthor_u📈id: 1\n---\nAnd so it goes on.")[0] == ("And so it goes on.", True)
    assert found("Das war gut. # no\n# Yes!\nnot so") == [("Das war gut.", True), ("# no", False), ("# Yes!", False), ("not so", False)]
    assert found("text\n---\nmore of the text here") == [("text", False), ("more of the text here", True)]
    assert language.sentences("") == [] and language.sentences("+1.2% / 33") == []


def test_languages_of_documents(spark, profiles):
    texts = ["".join(ZH), " ".join(EN), " ".join(DE), " ".join(FR), " ".join(ES), " ".join(PT), "".join(JA)]
    mixed = ZH[0] + "\n" + " ".join(EN) + "\n" + ZH[1]
    quoted = "所谓 risk on 和 risk off，说到底还是大家在等消息。"
    odd = [None, "", " \n", "12.5 / 33%", "---\na: b\n---\n", "# 标题", "x" * 100_000]
    rows = [
        *((i, t, code) for i, (t, code) in enumerate(zip(texts, language.LANGUAGES))),
        (10, mixed, "zh"),
        (11, quoted, "zh"),
        (12, texts[0], "en"),
        (13, texts[1], None),
        *((20 + i, t, None) for i, t in enumerate(odd)),
        (0, texts[0], "zh"),
    ]
    df = spark.createDataFrame(rows, DOCUMENT).withColumn("segments", F.lit("clash"))
    got = language.identify(df, profiles)
    by = {r["doc_id"]: r for r in got.collect()}
    assert [[s["lang_code"] for s in by[i]["segments"]] for i in range(7)] == [[c] for c in language.LANGUAGES]
    assert [(s["lang_code"], s["n_sentences"]) for s in by[10]["segments"]] == [("zh", 1), ("en", 3), ("zh", 1)]
    assert mixed[by[10]["segments"][1]["char_start"] : by[10]["segments"][1]["char_end"]].strip() == " ".join(EN)
    assert [s["lang_code"] for s in by[11]["segments"]] == ["zh"]
    assert all(0 <= s["confidence"] <= 1 for r in by.values() for s in r["segments"])
    assert [len(by[20 + i]["segments"]) for i in range(5)] == [0] * 5 and by[25]["segments"][0]["n_sentences"] == 0
    found = {tuple(r) for r in language.mislabelled(got).where("doc_id < 20").collect()}
    assert found == {(10, "zh"), (10, "en"), (12, "zh"), (13, "en")}
    assert got.count() == len(rows) and language.identify(df.limit(0), profiles).count() == 0


SHORT = {
    "zh": "今天很好。 我不知道。 他走了。 大家都在等。 这很简单。 市场下跌了。 我们看好。 没有消息。 风险很大。 机会不多。",
    "en": "That was good. We will see. I am waiting. Nobody knows why. Prices fell again. The market closed. He was right. They sold everything. Time will tell. We are late.",
    "de": "Das war gut. Wir werden sehen. Ich warte noch. Niemand weiß warum. Der Markt schloss. Er hatte recht. Sie verkauften alles. Alles wird gut. Kurse fielen wieder. Das reicht nicht.",
    "fr": "C'était très bien. Nous verrons bien. J'attends toujours. Personne ne sait. Le marché ferma. Il avait raison. Ils vendirent tout. Tout ira bien. Les cours baissent. Cela ne suffit pas.",
    "es": "Estuvo muy bien. Ya lo veremos. Yo sigo esperando. Nadie sabe nada. El mercado cerró. Él tenía razón. Lo vendieron todo. Todo saldrá bien. Los precios bajaron. Eso no basta.",
    "pt": "Foi muito bom. Vamos ver isso. Eu ainda espero. Ninguém sabe nada. O mercado fechou. Ele tinha razão. Eles venderam tudo. Tudo vai bem. Os preços caíram. Isso não basta.",
    "ja": "とても良かった。 様子を見よう。 まだ待っています。 誰も知らない。 市場が閉まった。 彼は正しい。 全部売った。 それだけです。 きっと大丈夫。 また下がった。",
}
FULL = Path("/root/testdata/sf0.1")


@pytest.mark.skipif(not FULL.exists(), reason="no test tables")
def test_planted_short_sentences(spark):
    """A sentence of about three words within a text of another language, and within one of its own."""
    documents = spark.read.parquet(f"{FULL}/documents.parquet")
    profiles = language.learn_profiles(documents)
    long = dict(zip(language.LANGUAGES, (ZH, EN, DE, FR, ES, PT, JA)))
    cases = [
        (
            own,
            other,
            f"{long[other][0]} {s} {long[other][1]}",
        ) for own, group in SHORT.items() for s in regex.split(r"(?<=[.。]) ", group) for other in long
    ]
    df = spark.createDataFrame([(i, text, other) for i, (_, other, text) in enumerate(cases)], DOCUMENT)
    got = {r["doc_id"]: {s["lang_code"] for s in r["segments"]} for r in language.identify(df, profiles).collect()}
    foreign = [got[i] == {own, other} for i, (own, other, _) in enumerate(cases) if own != other]
    alone = [got[i] == {own} for i, (own, other, _) in enumerate(cases) if own == other]
    assert sum(foreign) / len(foreign) >= 0.9 and sum(alone) / len(alone) >= 0.9


def test_main_languages(spark, profiles):
    df = spark.createDataFrame([(1, ZH[0] + "\n" + " ".join(EN), "zh"), (2, None, "en"), (3, "12 %", None)], DOCUMENT)
    got = {r["doc_id"]: r for r in language.main_languages(language.identify(df, profiles)).collect()}
    assert [(r["label_code"], r["lang_code"], r["n_segments"]) for _, r in sorted(got.items())] == [("zh", "en", 2), ("en", None, 0), (None, None, 0)]
    assert 0 < got[1]["confidence"] <= 1 and got[2]["confidence"] is None
    assert language.main_languages(language.identify(df.limit(0), profiles)).count() == 0


def test_learning_from_a_table(spark):
    rows = [
        (i, s, code) for i, (code, s) in enumerate((c, s) for c, group in zip(language.LANGUAGES, (ZH, EN, DE, FR, ES, PT, JA)) for s in group)
    ] + [(99, ZH[0], "en"), (100, None, "zh")]
    learned = language.learn_profiles(spark.createDataFrame(rows, DOCUMENT))
    names = [language.LANGUAGES[k] for k in learned.judge([ZH[1], EN[1], ES[1], PT[1]])[0]]
    assert names == ["zh", "en", "es", "pt"]
    assert learned.codes.size and language.learn_profiles(spark.createDataFrame([], DOCUMENT)).codes.size


# Answers

RESULT, PROMPT = "result_id bigint, prompt_id bigint, key_points array<string>, market_view string", "prompt_id bigint, prompt string"
PROMPT_ZH = "请阅读下面这篇博文，列出要点。\n标题：周末闲聊\n内容：" + "".join(ZH)
PROMPT_EN = "Read the blog post below and list its key points.\nContent: " + " ".join(EN)


def test_broken_answers(spark, profiles):
    good = "作者认为市场短期仍会上涨，建议先等一等。"
    cases = {
        1: (1, ["无", None, "-"], "n/a"),
        2: (1, None, None),
        3: (1, ["抱歉，我无法对这篇文章作出评价。"], "As a language model, I cannot comment on this article."),
        4: (1, [good], "作者说“我给不出确切点位”，意思是先等一等。"),
        5: (1, [ZH[0].upper()], "标题：周末 闲聊"),
        6: (1, [EN[0]], EN[1]),
        7: (2, ["Watch the size, as turnover was lower."], "所以说作者认为市场还是会上涨的，大家都在等。"),
        8: (1, [good, "作者认为市场短期仍"], good + "作者认为市场短期"),
        9: (1, ["控制好自己的仓位", "等待市场消息"], good),
        10: (1, ["等待市场消息"], "整体偏谨慎……"),
        11: (3, [good], good),
        12: (1, [good, "等待市场消息，以及"], good),
        13: (2, ["The author expects the market to be calm around 3288."], "The author is calm and expects support around 3288."),
    }
    df = spark.createDataFrame([(i, *v) for i, v in cases.items()] + [(4, *cases[4])], RESULT).withColumn("prompt", F.lit("clash"))
    prompts = spark.createDataFrame([(1, PROMPT_ZH), (2, PROMPT_EN), (3, None), (1, PROMPT_ZH)], PROMPT)
    got = {(r["result_id"], r["field_name"]): r["defect"] for r in answers.broken_answers(df, prompts, profiles).collect()}
    want = {
        1: ("empty", "empty"),
        2: ("empty", "empty"),
        3: ("refusal", "refusal"),
        5: ("copied", "copied"),
        6: ("other_language", "other_language"),
        7: (None, "other_language"),
        8: ("truncated", "truncated"),
        10: (None, "truncated"),
        12: ("truncated", None),
    }
    assert got == {(i, f): d for i, ds in want.items() for f, d in zip(("key_points", "market_view"), ds) if d}
    assert answers.broken_answers(df.limit(0), prompts.limit(0), profiles).count() == 0


def cut_up(spark, items):
    rows = [answers.units_of(answers.items_of(a or [])) for a in items]
    return spark.createDataFrame(rows, "units array<string>, tail string")


def test_shortened_units(spark):
    items = [
        ["a complete short item", "position below #"],
        ["position below 3%", "x y"],
        ["position belo"],
        ["end of it."],
        None,
        ["", None],
    ] + [[f"unit {i} of many.", f"unit {i} of"] for i in range(50)]
    got = {r["tail"]: (r["complete"], r["shortened"]) for r in answers.open_units(cut_up(spark, items)).collect()}
    assert got["position belo"] == (False, True) and got["x y"] == (False, False) and got["unit # of"] == (False, True)
    assert "end of it." not in got


def test_sorted_neighbours_as_brute_force_has_them(spark):
    r = random.Random(8)
    items = [[r.choice("ab") * r.randrange(1, 5) + r.choice(["", "c", "cd", "."]) for _ in range(r.randrange(1, 4))] for _ in range(200)]
    complete, tails = set(), set()
    for a in items:
        units, tail = answers.units_of(a)
        complete |= set(units if tail is None else units[:-1])
        tails |= {tail} - {None}
    got = {x["tail"]: x["shortened"] for x in answers.open_units(cut_up(spark, items).repartition(5)).collect()}
    assert got == {t: any(u.startswith(t) and u != t for u in complete) for t in tails}


def test_length_limits(spark):
    rows = [
        ("market_view", f"t{n} {k}", n) for n in range(40, 60) for k in range(3)
    ] + [("market_view", f"u{k}", 50) for k in range(60)] + [("key_points", "the same", 50)] * 90
    df = spark.createDataFrame(rows, "field_name string, tail string, size bigint")
    assert [tuple(r) for r in answers.length_limits(df).collect()] == [("market_view", 50)]
    assert answers.length_limits(df.limit(0)).count() == 0


def test_evidence_of_truncation(spark, profiles):
    """A planted limit of 40 characters, shortened versions, and answers that only marks and words show to be cut."""
    r = random.Random(5)
    words = "市场消息仓位成交现金耐心等待上涨下跌风险机会交易心态均线量能板块指数资金策略".strip()
    long = lambda: "".join(r.choice(words) for _ in range(60))
    whole = [f"作者认为{long()}。" for _ in range(40)]
    rows = [(i, 1, [w], w) for i, w in enumerate(whole)]
    rows += [(100 + i, 1, [f"看好{long()}"[:40]], whole[0]) for i in range(40)]
    rows += [(200 + i, 1, [w[: r.randrange(8, 39)]], w) for i, w in enumerate(whole[:15])]
    rows += [(300, 1, [whole[0], "等待消息，以及"], whole[1][:20]), (301, 1, [whole[0]], "短期偏谨慎")]
    prompts = spark.createDataFrame([(1, PROMPT_ZH)], PROMPT)
    got = {
        (x["result_id"], x["field_name"]): (x["defect"], x["evidence"]) for x in answers.answer_defects(
            spark.createDataFrame(rows, RESULT),
            prompts,
            profiles,
        ).collect()
    }
    want = {(100 + i, "key_points"): "limit" for i in range(40)} | {(200 + i, "key_points"): "neighbour" for i in range(15)}
    want |= {(300, "key_points"): "style", (300, "market_view"): "neighbour", (301, "market_view"): "mark"}
    assert got == {k: ("truncated", e) for k, e in want.items()}


# Written after the patterns and not used to make them.
REFUSED = """I apologize, but I can't provide an analysis of this post.
Sorry, I am not able to give trading recommendations.
I cannot summarize this content.
As an AI language model, I have no access to the market.
I must decline to answer this.
Es ist mir nicht möglich, diesen Text zu bewerten.
Ich kann dazu leider nichts sagen.
Ich darf keine Anlageempfehlungen geben.
Als KI habe ich keine eigene Meinung dazu.
Je ne peux pas fournir de conseils financiers.
Il m'est impossible de résumer ce texte.
En tant qu'assistant, je n'ai pas d'avis sur ce sujet.
No puedo ofrecer recomendaciones de inversión.
No me es posible resumir este contenido.
Como modelo de lenguaje, carezco de opiniones.
Não posso fornecer recomendações de investimento.
Não me é possível resumir este conteúdo.
Como modelo de linguagem, não tenho acesso ao mercado.
申し訳ございませんが、要約することはできません。
その質問にはお答えできません。
言語モデルであるため、投資助言は行えません。
抱歉，我无法提供这方面的分析。
作为一个人工智能助手，我没有办法判断行情。
对不起，我不能回答这个问题。
这个要求我满足不了。
我不便评论他人的文章。""".split("\n")
SAID = """The author says he cannot name a level and waits for news.
Der Autor kann keine Richtung erkennen und wartet ab.
L'auteur ne peut pas dire où va le marché.
El autor reconoce que no puede adivinar el rumbo.
O autor admite que não consegue prever o rumo.
作者は方向を予測できないと述べている。
作者坦言目前无法判断突破方向，只谈应对。
有人请作者推荐个股，作者婉拒了。""".split("\n")


def test_held_out_refusals():
    found = [bool(answers.REFUSALS.search(x)) for x in REFUSED]
    assert sum(found) / len(found) >= 0.9
    assert not any(answers.REFUSALS.search(x) for x in SAID)


# Residue

POST = "post_row bigint, title string, body string"
REAL = [
    "今天市场有所上涨，大家都在等消息。成交额比前一天少了一截。",
    "有读者问仓位怎么控制，我的回答是先等一等。[图片]\n[上一篇](http://x/y)",
    "The market went up today. «Buy the dip» is not enough.",
    "我用 JavaScript 写了个画线的小脚本，收盘后跑一遍就够了。市场还在等消息，成交额少了一截。",
    "页面上的报价加载失败了两次，好在没有误操作。今天大盘缩量，我还是少看分时图，耐心等待。",
    "计划表里留了一列 {risk}，每天收盘以后填。仓位不高于半仓，心态比较稳。",
]
BROKEN = [
    "# 标题\n\n请在浏览器中启用 JavaScript 后继续访问。",
    "404 Not Found\n\nThe requested address was not found on this server.",
    "测试测试测试测试测试",
    "您访问的页面不存在或已被删除，4秒后返回首页",
    "今日收于{{index_close}}点，成交额比前一天少了一截。市场还在等消息。",
    "大家好，我是【请在此输入作者】，有读者问仓位怎么控制。",
    "Lorem ipsum dolor sit amet, consectetur.",
    "摘要：{title}\n\n今天市场有所上涨，大家都在等消息。",
]


def test_residue(spark):
    rows = [(i, "市场还在等消息", t) for i, t in enumerate(REAL * 20)] + [(1000 + i, "加载中…" if i == 0 else "今天市场", t) for i, t in enumerate(BROKEN)] + [
        (2000, None, ""),
        (2001, " ", None),
        (2002, "{{ title }}", "".join(REAL[:2]) * 900),
        (2003, "今天市场", "测试" * 25_000),
    ]
    df = spark.createDataFrame(rows, POST).withColumn("score", F.lit("clash"))
    model = residue.learn_model(df)
    scores = residue.residue_scores(df, model)
    found = {(r["post_row"], r["field_name"]) for r in scores.where(residue.is_residue()).collect()}
    assert found == {(1000, "title"), (2002, "title"), (2003, "body"), *((1000 + i, "body") for i in range(len(BROKEN)))}
    assert scores.where("post_row in (2000, 2001)").count() == 0
    assert residue.residue_scores(df.limit(0), residue.learn_model(df.limit(0))).count() == 0


def test_slots_of_any_length(spark):
    long = [
        "{{replace this text with the title of your own post, please, before you publish it}}",
        "[insert two sentences about the company and its market here, or leave this paragraph out]",
        "<!-- the author's\nown words go here -->",
    ]
    rows = [(i, None, t) for i, t in enumerate(REAL * 20)] + [
        (100_000 + i, None, f"今天市场有所上涨。{t}大家都在等消息。") for i, t in enumerate([*long, "[这里是作者自己写的一段很长的话，" + "说的是市场。" * 40 + "]"])
    ]
    rows += [(200_000 + i, None, t) for i, t in enumerate(["摘要：[insert title here]", "标题 {{ post.title }}", "今天 <!-- body goes here -->"] * 3)]
    df = spark.createDataFrame(rows, POST)
    found = {r["post_row"] for r in residue.residue_scores(df, residue.learn_model(df)).where(residue.is_residue()).collect()}
    assert found & set(range(100_000, 200_000)) == {100_000, 100_001, 100_002}


def test_residue_is_left_out(spark, monkeypatch):
    rows = [(i, "市场还在等消息", t) for i, t in enumerate(REAL * 20)] + [(1000 + i, "今天市场", t) for i, t in enumerate(BROKEN)]
    rows += [(None, "加载中…", None), (2001, " ", ""), (2002, "{{ title }}", "".join(REAL[:2]) * 900)]
    df = spark.createDataFrame(rows, POST).withColumn("score", F.array(F.lit("clash"), F.lit(None)))
    model = residue.learn_model(df)
    found = {(r["post_row"], r["field_name"]) for r in residue.residue_scores(df, model).where(residue.is_residue()).collect()}
    monkeypatch.setattr(residue, "AT_ONCE", 100)
    clean = residue.without_residue(df, model)
    assert clean.schema == df.schema
    want = {(k, None if (k, "title") in found else t, None if (k, "body") in found else b) for k, t, b in rows}
    assert {tuple(r)[:3] for r in clean.collect()} == want and (None, None, None) in want
    assert residue.without_residue(df.limit(0), model).count() == 0


@pytest.mark.skipif(not FULL.exists(), reason="no test tables")
def test_records_held_out_of_the_trusted():
    """Half of the trusted fields and slots are given to the classifiers as unlabelled; it must find them."""
    import duckdb

    fields = [
        t for row in duckdb.sql(
            f"SELECT title, body FROM '{FULL}/posts.parquet' ORDER BY hash(post_row) LIMIT 10000"
        ).fetchall() for t in row if t and t.strip()
    ]
    seen: list[str] = []

    def half(rule):
        def trust(text: str) -> bool:
            if rule(text):
                seen.append(text)
            return rule(text) and len(seen) % 2 == 0

        return trust

    model = residue.ResidueModel(fields, half(residue.trusted), half(residue.trusted_slot))
    held = [t for t in fields if residue.trusted(residue.prose(t)) or any(map(residue.trusted_slot, residue.slots(t)))]
    assert len(held) > 300 and sum(map(residue_like, model.judge(held))) / len(held) >= 0.95


def test_held_out_residue():
    r = [t for t in REAL * 30]
    model = residue.ResidueModel(r + BROKEN[:4])
    judge = [
        residue_like(x) for x in model.judge(
            ["Bitte aktivieren Sie JavaScript, um die Seite zu sehen.", "404 Page Not Found", "JavaScript を有効にしてください。", *REAL[:3]]
        )
    ]
    assert judge == [True, True, True, False, False, False]


def residue_like(x):
    return residue.residue(*x)
