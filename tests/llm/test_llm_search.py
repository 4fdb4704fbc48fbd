"""Decontamination, URL filter and license scan."""

import numpy as np
import pytest
from llm_cases import LONG, by_id, empty, messy
from pyspark.sql import functions as F

import tallyworks.llm.license_scan as license_scan_module
from tallyworks.llm.decontamination import contaminated, words_of, without_contaminated
from tallyworks.llm.license_scan import NOTICES, edits_allowed, license_scan, seeds
from tallyworks.llm.url_filter import judge_urls


def items(spark, *rows):
    return spark.createDataFrame(list(rows), "item_id bigint, text string")


def test_items_inside_documents(spark):
    passage = " ".join(LONG.split()[500:540])
    near = passage.split()
    near[20] = "changed"  # 5 of 36 shingles go: 0.861
    far = list(near)
    far[3] = far[30] = "changed"
    docs = messy(spark).unionByName(messy(spark, [(20, "Intro, " + " ".join(near).upper() + "!"), (21, " ".join(far)), (22, "seven three")]))
    asked = items(spark, (1, passage), (2, passage), (3, None), (4, ""), (5, "Seven THREE"), (6, "one two three four"))
    got = {(r.doc_id, r.item_id): round(r.containment, 3) for r in contaminated(docs, asked).collect() if r.doc_id is not None}
    assert got == {
        (6, 1): 1.0, (6, 2): 1.0, (20, 1): 0.861, (20, 2): 0.861, (22, 5): 1.0, (1, 6): 1.0, (5, 6): 1.0,
    }
    kept = [r.doc_id for r in without_contaminated(docs, asked).collect()]
    assert sorted(k for k in kept if k is not None) == [2, 3, 4, 7, 8, 21]
    assert without_contaminated(docs, asked).columns == docs.columns


def test_no_items_or_documents(spark):
    assert contaminated(messy(spark), items(spark)).count() == 0
    assert contaminated(empty(spark), items(spark, (1, "a b c d e f"))).count() == 0
    assert without_contaminated(messy(spark), items(spark)).count() == messy(spark).count()


def test_decontamination_is_native(spark):
    docs = messy(spark)
    plan = contaminated(docs, items(spark, (1, "a b c d e f")))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("size", [1, 4, 5, 6, 9, 17, 40])
def test_containment_against_brute_force(spark, size):
    words = [f"w{i % 7}{i % 3}" for i in range(60)]
    docs = [(i, " ".join(words[i : i + 25 + i])) for i in range(0, 30, 3)]
    item = words[10 : 10 + size]
    n = min(5, size)
    cut = lambda w: {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
    want = {i for i, t in docs if len(cut(item) & cut(t.split())) >= 0.8 * len(cut(item)) - 1e-9}
    got = {r.doc_id for r in contaminated(messy(spark, docs), items(spark, (1, " ".join(item)))).collect()}
    assert got == want


def test_words(spark):
    df = spark.createDataFrame([("It's É-1, ok_2\n",)], "t string").select(words_of(F.col("t")))
    assert df.first()[0] == ["it", "s", "é", "1", "ok", "2"]


RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def urls(spark, *values):
    return spark.createDataFrame([(i, u, 1, 2) for i, u in enumerate(values)], "page_id bigint, url string, host int, rule int")


def test_rules_and_list(spark):
    pages = urls(
        spark, "http://WWW.a.Example.org/es/x?q#f", "https://example.org/en/12", "http://notexample.org/es/", "x://a.com/de/", None, "nothing", "",
        "http://spam.net/a.html?utm=1", "https://m.spam.net/a", "http://spam.net/b", "http://org", "a://b://c/d", "http://xcom/de/", "http://com/fr/",
        "http://spam.net/a",
    )
    listed = urls(spark, "http://www.spam.net/a/", None, "bad", "http://www.spam.net/a/")
    got = {i: r for i, r in by_id(judge_urls(pages, listed, RULES), "page_id").items()}
    assert [got[i].rule for i in range(15)] == [
        "example.org/es/", "example.org/en/1", "org/", "com/de/", None, None, None, None, None, None, None, None, None, "com/fr/", None,
    ]
    assert [got[i].verdict for i in range(15)] == [
        "block", "block", "allow", "block", "allow", "allow", "allow", "block", "block", "allow", "allow", "allow", "allow", "allow", "block",
    ]
    assert (got[0].host, got[0].path) == ("www.a.example.org", "/es/x") and (got[4].host, got[4].path) == ("", "")
    assert (got[11].host, got[11].path) == ("b:", "//c/d")


def test_a_full_filter_gives_the_same_verdicts(spark):
    pages = urls(spark, *[f"http://h{i}.net/p" for i in range(500)])
    listed = pages.filter("page_id % 5 = 0")
    for blocks in (1, 1 << 16):
        got = judge_urls(pages, listed, (), max_blocks=blocks).filter("verdict = 'block'").count()
        assert got == 100
    assert judge_urls(pages, listed.limit(0)).filter("verdict = 'block'").count() == 0
    assert judge_urls(pages.limit(0), listed).count() == 0


def test_phrases_and_notices(spark):
    texts = [
        (1, "The MIT license. mit-License; submit license"),
        (2, "Released undr the MIT Licence."),
        (3, "Licensed under CC BY-NC 4.0."),
        (4, "licensed under the apache licence version 2 0 " * 3),
        (5, None),
        (6, "general public license " + "x " * 50_000 + "GENERAL\nPUBLIC, LICENSE"),
        (7, "é" * 10 + " mit license"),
        (8, "nothing of the kind"),
    ]
    got = by_id(license_scan(messy(spark, texts)))
    assert (got[1].n_words, got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels) == (7, 2, 1, 3, "mit")
    assert (got[2].n_base, got[2].base_labels, got[2].labels) == (0, "", "mit") and 0 < got[2].score < 1
    assert got[2].spans[0].edits == 2 and got[2].first_word is None
    assert got[3].labels == "cc-by-nc" and got[4].labels == "apache" and len(got[4].spans) == 3
    assert (got[5].n_words, got[5].score, got[5].labels) == (0, 0.0, "")
    assert (got[6].n_base, got[6].first_word, got[6].last_word) == (2, 0, 50_003)
    assert got[7].n_words == 3 and got[8].labels == ""
    assert license_scan(empty(spark)).count() == 0 and license_scan(messy(spark)).count() == 10


def test_seeds_cover_a_notice():
    for text, _, _ in NOTICES:
        assert "".join(p for _, p in seeds(text)) == text and len(seeds(text)) == edits_allowed(text) + 1


@pytest.mark.parametrize(
    "text, labels",
    [
        ("licensed under CC BY-SA 4.0", "cc-by-sa"), ("Licensed under CC BY-ND 4.0.", "cc-by-nd"), ("licensed under CC BY 4.0", "cc-by"),
        ("licensed under CC BY-NC-SA 4.0", "cc-by-nc-sa"), ("Released under the MPL license", "mpl"), ("Released under the ISC license", "isc"),
        ("released under the BSD licence", "bsd"), ("Licensed under a Creative Commons Attribution NonCommercial", "cc-by-nc"),
        ("licensed under a Creative Commons Attribution", "cc-by"), ("licensed under a creative commons attribution share alike", ""),
        ("licensed under a creative commons attribution-noncommercial-sharealike", "cc-by-nc-sa"), ("released under the xyz license", ""),
        ("Licensed under the GNU Lesser General Public License version 3", "gpl,lgpl"), ("licensed under the gnu general public licence version", "gpl"),
        ("licensed under the gnu affero general public licence version", "agpl"), ("released under the mut license", ""),
    ],
)
def test_sibling_licenses_are_kept_apart(text, labels):
    """Names differ by less than the edits allowed elsewhere. The phrase of the lesser license holds that of the general one."""
    assert license_scan_module.NoticeSearch().row(1, text)[6] == labels


def distance_in(notice, text):
    """The least edit distance of the notice to any part of the text, by dynamic programming."""
    row = np.zeros(len(text) + 1, int)
    for i, c in enumerate(notice, 1):
        best = np.minimum(row[:-1] + (np.array(list(text)) != c), row[1:] + 1)
        new = np.append(i, best)
        for j in range(1, len(new)):
            new[j] = min(new[j], new[j - 1] + 1)
        row = new
    return int(row.min())


def test_notices_against_every_part_of_the_text():
    """Each notice with edits outside its naming words, in other words: a label is found where the distance
    allows it and the naming words are there, and no other label is."""
    rng = np.random.default_rng(3)
    search = license_scan_module.NoticeSearch(phrases={})
    letters = list("abcdefghijklmnopqrstuvwxyz")
    found = missed = 0
    for _ in range(12):
        for notice, label, names in NOTICES:
            words = notice.split()
            for _ in range(int(rng.integers(0, edits_allowed(notice) + 3))):
                free = [i for i, w in enumerate(words) if len(w) > 2 and w not in names.split()]
                if not free:
                    break
                i, c = rng.choice(free), rng.choice(letters)
                k = int(rng.integers(1, len(words[i])))
                words[i] = [words[i][:k] + words[i][k + 1 :], words[i][:k] + c + words[i][k:], words[i][:k] + c + words[i][k + 1 :]][int(rng.integers(3))]
            around = [" ".join("".join(rng.choice(letters, 5)) for _ in range(int(rng.integers(0, 6)))) for _ in range(2)]
            text = " ".join(f"{around[0]} {' '.join(words)} {around[1]}".split())
            near = distance_in(notice, text) <= edits_allowed(notice)
            got = set(search.row(1, text)[6].split(",")) - {""}
            assert got <= {label} if near else label not in got or len(got) == 1, (text, got)
            assert (label in got) >= near, (text, got)
            found, missed = found + near, missed + (not near)
    assert found > 150 and missed > 20
