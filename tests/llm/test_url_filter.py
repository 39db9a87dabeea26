import random
import re

import numpy as np

from patronage.llm import url_filter


def regex(glob):
    return re.compile("".join({"^": "[^\\n]*", "*": "(?s:.*)", "|": "\\n"}.get(c, re.escape(c)) for c in glob))


def test_automaton_fits_what_regular_expressions_fit():
    source = random.Random(6)
    globs = ["".join(source.choice("ab/.^*|") for _ in range(source.randrange(1, 12))) for _ in range(60)] + ["x" * 100 + "*y", "*" + "ab" * 40, "", "*", "^|*"]
    machine = url_filter.Automaton(globs)
    assert machine.words > 5
    texts = ["".join(source.choice("ab/.x") for _ in range(source.randrange(0, 30))) for _ in range(300)] + ["x" * 100 + "abcy", "x" * 99 + "y", "q" + "ab" * 40]
    texts = [t[:k] + "\n" + t[k:] for t in texts for k in [source.randrange(len(t) + 1)]] + texts[-3:]
    codes, lengths = np.zeros((len(texts), max(map(len, texts))), np.int16), np.array([len(t) for t in texts])
    for k, text in enumerate(texts):
        codes[k, : len(text)] = [url_filter.BAR if c == "\n" else ord(c) for c in text]
    found = machine.run(codes, lengths)
    patterns = [regex(g) for g in globs]
    for k, text in enumerate(texts):
        assert found[k].tolist() == [p.fullmatch(text) is not None for p in patterns], text


def test_rules_hosts_and_paths(spark):
    cases = {
        "http://Example.ORG/es/1": ("example.org", "/es/1", "example.org/es/", "block"),
        "https://a.example.org/en/1?x#y": ("a.example.org", "/en/1", "example.org/en/1", "block"),
        "https://a.example.org/en/2#/es/": ("a.example.org", "/en/2", "org/", "allow"),
        "https://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
        "http://x.com/fr/": ("x.com", "/fr/", "com/fr/", "allow"),
        "http://x.com/de/": ("x.com", "/de/", "com/de/", "block"),
        "http://x.com?/de/": ("x.com", "", None, "allow"),
        "http://org": ("org", "", None, "allow"),
        "http://x.net/org/": ("x.net", "/org/", None, "allow"),
        "http://ads.x.net/a": ("ads.x.net", "/a", None, "block"),
        "mailto:a@b": ("", "", None, "allow"),
        "://": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        "http://é.org/ü" + "x" * 20_000: ("é.org", "/ü" + "x" * 20_000, "org/", "allow"),
    }
    rows = [(k, url) for k, url in enumerate(cases)] + [(0, next(iter(cases))), (None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("page_id", "url", "1 AS rule")
    found = url_filter.judge(pages).collect()
    assert len(found) == len(rows)
    wanted = list(cases.values())
    for r in found:
        assert (r.host, r.path, r.rule, r.verdict) == (("", "", None, "allow") if r.page_id is None else wanted[r.page_id])
    assert url_filter.judge(pages.limit(0)).count() == 0
