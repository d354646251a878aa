"""Small tables for the tests of the llm operators."""

import random

WORDS = ("the of and to in that river stone winter garden letter market window silver thunder copper meadow "
         "lantern harbor orchard candle shadow velvet timber hollow anchor bridge feather marble").split()
GERMAN = "der die das und nicht über schön straße wälder häuser können größe müde grün fließt jahr zeit".split()


def prose(seed: int, n: int, vocabulary=WORDS) -> str:
    r = random.Random(seed)
    out = []
    for i in range(n):
        w = r.choice(vocabulary)
        out.append(w + (".\n" if i % 12 == 11 else ""))
    return " ".join(out)


PASSAGE = prose(99, 70)
LONG = prose(5, 40_000)
ITEM = prose(77, 30)
# (doc_id, text, lang, source)
EDGE_DOCS = [
    (1, prose(1, 120), "en", "a"), (2, prose(1, 120), "en", "a"),          # equal texts
    (3, prose(1, 120) + " extra words here", "en", "b"),                    # a near copy
    (4, None, "en", "b"), (5, "", None, "b"), (6, " \n\t ", "en", None),    # null, empty, blank
    (7, LONG, "en", "c"), (8, prose(8, 60) + " " + PASSAGE, "en", "c"), (9, PASSAGE + " " + prose(9, 60), "en", "c"),
    (10, prose(10, 20) + " " + ITEM + " " + prose(11, 20), "en", "d"),
    (11, "Call +1 (243) 555-5526, mail a.b@example.org or 10.0.0.1; card 4111111111111111.", "en", "d"),
    (12, "#%$ " * 80, None, "e"), (13, "word " * 90, "en", "e"),
    (14, prose(14, 90, GERMAN), "de", "e"), (15, prose(15, 90, GERMAN), "de", "é"),
    (16, "Licensed under the Apache License, Version 2.0. The MIT License", "en", "é"),
    (17, "12345 --- 67890", "en", "f"), (18, "one", "en", "f"), (18, "one", "en", "f"),  # a repeated row
    (None, prose(1, 120), "en", "f"), (None, PASSAGE, None, None), (21, "日本語のテキスト", "ja", "g"),
    (22, "\x1ca\x85b c \x0bd", "en", "g"), (-5, prose(1, 120) + " y", "en", "g"),
] + [(100 + i, prose(500 + i, 80), "en", "h") for i in range(30)] + [
    (200 + i, prose(700 + i, 80, GERMAN), "de", "h") for i in range(30)]


_LONG_TALK = [(7, k, ("user", "assistant", "system", "tool")[k * k % 4], f"row {k % 5}" + ("." if k % 3 else "")) for k in range(40)]
# (conv_id, turn, role, text)
EDGE_TALKS = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Hello!"), (1, 3, "user", "Bye?"), (1, 4, "assistant", "Bye."),
    (2, 0, "user", None), (2, 1, None, "No role."), (2, None, "assistant", "No turn"), (2, None, None, None), (2, 9, "user", "Far."),
    (3, 0, "User", "Upper."), (3, 0, "user", "A tie."), (3, 0, "user", "Another tie."), (3, 0, "", "No name."), (3, 5, "user", " \n\t"),
    (4, 1, "user", "Same."), (4, 1, "user", "Same."), (4, 1, "user", "Same."), (4, 2, "user", "Same."), (4, 2, "assistant", "Same."),
    (None, 0, "user", "No id."), (None, 1, "assistant", "None at all."), (None, None, "system", "Nothing"),
    (5, 0, "assistant", LONG), (5, 1, "user", "日本語。"), (5, 2, "assistant", "Ends in a dash -  \n"), (6, 3, "system", "Alone."),
] + [(5, 2 ** 62, "user", "Late."), (5, -2 ** 62, "user", "Early.")] + _LONG_TALK + [(100 + c, t, r, f"{c % 3} says {t % 2}" + "?" * (c % 2))
     for c in range(40) for t, r in enumerate(("user", "assistant") * (c % 4))]


def write_tables(spark, folder: str, docs, empty: bool = False) -> str:
    rows = [(d, t, lang, s, None if t is None else len(t), 0.5, 7, "x", True, 1, "t", "c") for d, t, lang, s in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, "
                                "n_words long, Masked string, kept boolean, component_id long, `a.b` string, "
                                "_hit_n string").coalesce(2).write.parquet(f"{folder}/documents.parquet")
    labels = [] if empty else [(d, int(d not in (12, 13)), 0) for d, _, _, _ in docs if d is not None] + [
        (None, 1, 0), (1, None, None), (999, 0, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{folder}/labels.parquet")
    items = [] if empty else [(1, ITEM), (2, "one"), (3, None), (4, " "), (None, "10 0 0 1"), (5, ITEM), (1, ITEM),
                              (30, "river stone winter garden letter market window silver thunder copper meadow lantern")]
    spark.createDataFrame(items, "item_id long, text string").coalesce(1).write.parquet(f"{folder}/benchmark.parquet")
    big = "<p>" + "x y " * 400 + "</p>"
    pages = [] if empty else [
        (1, "http://www.Example.com/a?b=1#f", big), (2, "https://b.org/ä x", big), (3, None, big), (4, "nonsense", "short"),
        (5, "http://[bad", "short"), (6, "http://c.net", None), (7, "http://c.net", ""), (7, "http://c.net", ""),
        (9, "http://c.net:81/\r\nX: y", big + "é"), (None, "http://d.org/n", big), (11, "http://d.org/n", big),
        (11, "http://d.org/n", big), (12, "http://e.org", "a\r\n\r\nWARC/1.1\r\n" * 100)]
    spark.createDataFrame([(*p, 1, "z") for p in pages], "page_id long, url string, html string, file int, urlkey string"
                          ).coalesce(2).write.parquet(f"{folder}/pages.parquet")
    talks = [] if empty else [(*t, "x", True, 1) for t in EDGE_TALKS]
    spark.createDataFrame(talks, "conv_id long, turn long, role string, text string, symbols string, whole boolean, copies int"
                          ).coalesce(2).write.parquet(f"{folder}/conversations.parquet")
    return folder
