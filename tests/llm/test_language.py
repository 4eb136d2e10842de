import random
import zlib

import numpy as np
from llm_rows import documents, odd_rows, with_clashing_columns

from tillmark.llm import language
from tillmark.llm.rows import held_out

SYLLABLES = {"xx": "the ing and ion".split(), "yy": "der sch ung ein".split(), "zz": "привет слово мир дом".split()}


def sentence(rng, lang, n=12):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def corpus(spark, n=400):
    rng = random.Random(4)
    langs = [rng.choice(list(SYLLABLES)) for _ in range(n)]
    rows = [(i, sentence(rng, lang), lang) for i, lang in enumerate(langs)]
    return rows, documents(spark, rows)


def test_held_out_documents_are_identified(spark):
    rows, docs = corpus(spark)
    model = language.train(docs)
    assert model.languages == ("xx", "yy", "zz")
    found = {row["doc_id"]: row["lang_pred"] for row in language.label_spans(docs, model).collect()}
    unseen = [(n, lang) for n, _, lang in rows if zlib.crc32(str(n).encode()) % 5 == 0]
    assert len(unseen) > 50 and sum(found[n] == lang for n, lang in unseen) >= 0.98 * len(unseen)


def test_the_held_out_fold(spark):
    ids = spark.createDataFrame([(n,) for n in range(50)] + [(None,), (-3,)], "doc_id long")
    for row in ids.select("doc_id", held_out(ids["doc_id"]).alias("h")).collect():
        text = "" if row["doc_id"] is None else str(row["doc_id"])
        assert row["h"] == (zlib.crc32(text.encode()) % 5 == 0)


def test_held_out_labels_teach_nothing(spark):
    rows, docs = corpus(spark)
    wrong = [(n, t, "qq" if zlib.crc32(str(n).encode()) % 5 == 0 else lang) for n, t, lang in rows]
    a, b = language.train(docs), language.train(documents(spark, wrong))
    assert a.languages == b.languages and np.array_equal(a.scores, b.scores)


def test_spans_of_mixed_text(spark):
    rng = random.Random(9)
    _, docs = corpus(spark)
    model = language.train(docs)
    parts = [(lang, sentence(rng, lang, 15)) for lang in ("xx", "zz", "yy")]
    text = "\n".join(part for _, part in parts)
    row = language.label_spans(documents(spark, [(1, text)]), model, spans=True).first()
    data = text.encode()
    assert [(s["lang"], data[s["start"] : s["end"]].decode()) for s in row["spans"]] == parts
    letters = {lang: sum(c.isalpha() for c in part) for lang, part in parts}
    assert row["lang_pred"] == max(letters, key=letters.get)
    assert abs(row["score"] - max(letters.values()) / sum(letters.values())) < 1e-9


UNSPACED_SYLLABLES = {
    "zh": "我们 他们 中国 学习 语言 今天 工作 问题".split(),
    "ja": "わたし たち です ます 学習 言語 ことば もんだい".split(),
    "th": "ภาษา ไทย วันนี้ เรียน ทำงาน คำถาม".split(),
}


def unspaced(rng, lang, n=30):
    return "".join(rng.choice(UNSPACED_SYLLABLES[lang]) for _ in range(n))


def test_scripts_without_spaces(spark):
    rng = random.Random(21)
    _, docs = corpus(spark, 200)
    learned = [(1000 + n, unspaced(rng, lang), lang) for lang in UNSPACED_SYLLABLES for n in range(80)]
    model = language.train(docs.unionByName(documents(spark, learned)))
    alone = [(n, unspaced(rng, lang), lang) for n, lang in enumerate(list(UNSPACED_SYLLABLES) * 20)]
    found = {r["doc_id"]: r for r in language.label_spans(documents(spark, alone), model).collect()}
    assert sum(found[n]["lang_pred"] == lang for n, _, lang in alone) >= 0.98 * len(alone)
    # No white space between languages, also next to a script that has some.
    for langs in (("zh", "th"), ("th", "xx"), ("zz", "ja", "xx"), ("zh", "ja"), ("zz", "xx")):
        parts = [(x, unspaced(rng, x) if x in UNSPACED_SYLLABLES else sentence(rng, x, 15)) for x in langs]
        text = "".join(part for _, part in parts)
        row = language.label_spans(documents(spark, [(1, text)]), model, spans=True).first()
        data = text.encode()
        spans = [(s["lang"], data[s["start"] : s["end"]].decode()) for s in row["spans"]]
        assert [lang for lang, _ in spans] == list(langs)
        if langs != ("zh", "ja"):
            assert spans == parts
        assert "".join(part for _, part in spans) == text


def test_words_end_where_the_script_does():
    def words(*texts):
        data = np.frombuffer("".join(texts).encode(), np.uint8)
        first = np.cumsum([0] + [len(text.encode()) for text in texts])
        found = language.read_words(data, first)
        return [bytes(data[a:b]).decode() for a, b in zip(found.start, found.end, strict=True)]

    assert words("naïve “café” e\u0301te\u0301 ǅ x²") == ["naïve", "“café”", "e\u0301te\u0301", "ǅ", "x²"]
    assert words("приветhello мир") == ["привет", "hello", "мир"]
    assert words("abc中文字符很多123def") == ["abc", "中文字符", "很多", "123def"]
    assert words("中文", "字x") == ["中文", "字", "x"]
    assert words("ไทยabc") == ["ไทย", "abc"]
    assert words("हिन्दी में") == ["हिन्दी", "में"]
    assert words("漢字かな交じり") == ["漢字", "かな", "交", "じり"]
    assert words("", "  ") == [] and words("中") == ["中"]


def test_scripts_leave_only_their_languages(spark):
    _, docs = corpus(spark)
    model = language.train(docs)
    allowed = {script: {model.languages[k] for k in np.flatnonzero(row)} for script, row in zip(language.SCRIPTS, model.allowed, strict=True)}
    assert allowed["latin"] == {"xx", "yy"} and allowed["cyrillic"] == {"zz"} and allowed["han"] == set()


def test_letters_of_all_scripts_count_and_other_signs_do_not(spark):
    rng = random.Random(14)
    syllables = {"te": "తెలు గువా క్యం పదం".split(), "km": "ខ្មែរ ភាសា អក្សរ".split(), "am": "አማርኛ ቋንቋ ሰላም".split()}
    learned = [(1000 + n, " ".join(rng.choices(syllables[lang], k=20)), lang) for lang in syllables for n in range(60)]
    _, docs = corpus(spark, 60)
    model = language.train(docs.unionByName(documents(spark, learned)))
    texts = ["తెలుగు గువా పదం", "ភាសា ខ្មែរ", "አማርኛ ቋንቋ", "×÷ × ÷", "١٢٣ ٤٥٦", "ἀἁἂ ἤἥ", "ﻼﻴ ﺑﺮ", "ｱｲｳ", "𠀀𠀁"]
    found = {r["doc_id"]: r for r in language.label_spans(documents(spark, list(enumerate(texts))), model).collect()}
    assert [found[k]["lang_pred"] for k in range(3)] == ["te", "km", "am"]
    assert [(found[k]["lang_pred"], found[k]["score"]) for k in (3, 4)] == [("und", 0.0)] * 2
    assert all(found[k]["lang_pred"] != "und" and found[k]["score"] > 0 for k in range(5, 9))


def test_odd_rows(spark):
    _, docs = corpus(spark, 60)
    model = language.train(docs.unionByName(documents(spark, [(500, None, "xx"), (501, "text", None), (None, "t", "xx")])))
    frame = with_clashing_columns(documents(spark, odd_rows(3000)))
    found = language.label_spans(frame, model).collect()
    assert len(found) == len(odd_rows())
    by_id = {row["doc_id"]: row for row in found}
    for doc_id in (1, 2, 3, 5):
        assert (by_id[doc_id]["lang_pred"], by_id[doc_id]["score"]) == ("und", 0.0)
    assert all(0 <= row["score"] <= 1 for row in found)
    kept = language.keep_identified(frame, model)
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == sorted(
        r["doc_id"] or 0 for r in found if r["lang_pred"] != "und" and r["score"] >= 0.5
    )


def test_nothing_learned(spark):
    model = language.train(documents(spark, []))
    row = language.label_spans(documents(spark, [(1, "some words")]), model, spans=True).first()
    assert tuple(row) == (1, "und", 0.0, [])
    assert language.label_spans(documents(spark, []), model).count() == 0
