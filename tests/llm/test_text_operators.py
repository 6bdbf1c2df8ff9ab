"""Each text operator against a brute-force version, and on NULLs, empty tables, repeats and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from fareway.llm import (
    bestfit_packing, covering_simhash, line_alignment, line_crf, lm_scoring, paragraph_minhash, pii_disclosure, pow2_packing,
    template_decontamination, viterbi_counts,
)
from fareway.llm import ppm
from fareway.llm.components import components
from fareway.llm.tokens import Encoder, vocabulary_path

SCHEMA = "doc_id long, text string, n_tokens string, spans string, fp int, doc string, bands int, k1 int, label int"
BPE = "byte_bpe_50k.json"


def frame(spark, rows):
    """Rows with columns whose names clash with those the operators make."""
    return spark.createDataFrame([(i, t, "x", "y", 1, "d", 2, 3, 4) for i, t in rows], SCHEMA)


def prose(seed, words, vocabulary=40):
    rnd = random.Random(seed)
    return " ".join("".join(chr(97 + (n * 7 + k) % 26) for k in range(2 + n % 6)) for n in (rnd.randrange(vocabulary) for _ in range(words)))


def corpus(seed=1, size=60):
    """Texts with copies, edited copies, odd white space, an empty one, a NULL, a NULL id and a repeated row."""
    rnd, out = random.Random(seed), []
    for i in range(size):
        if out and rnd.random() < 0.5:
            words = (rnd.choice(out)[1] or "").split(" ")
            for _ in range(rnd.choice((0, 0, 1, 3))):
                words[rnd.randrange(len(words))] = "Edit%d" % rnd.randrange(5)
            out.append((i, " ".join(words)))
        else:
            out.append((i, "\n".join(prose(rnd.random(), rnd.randint(1, 70), 400) for _ in range(rnd.randint(1, 4)))))
    return [*out, (size, ""), (size + 1, None), (None, "no id here"), out[3], (size + 2, " \t\r\n "), (size + 3, "a  b\n\n c "), (size + 4, "é😀 ñ\n日本")]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def low(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


@pytest.fixture(scope="module")
def rows():
    return corpus()


EMPTY = {
    "op1": lambda d: line_alignment.dedup_lines(d), "op2": lambda d: pii_disclosure.find_personal_data(d),
    "op2 text": lambda d: pii_disclosure.sanitise(d), "op3": lambda d: viterbi_counts.count_tokens(d),
    "op4": lambda d: template_decontamination.contaminated(d, d.selectExpr("doc_id item_id", "text")),
    "op5": lambda d: line_crf.label_lines(d, line_crf.fit_on(d, d.selectExpr("doc_id", "0 quality"))),
    "op6": lambda d: lm_scoring.score_documents(d), "op7": lambda d: covering_simhash.near_duplicates(d),
    "op7 first": lambda d: covering_simhash.keep_first(d), "op8": lambda d: pow2_packing.pack_powers(d),
    "op9": lambda d: bestfit_packing.pack_best_fit(d), "op10": lambda d: paragraph_minhash.repeated_paragraphs(d),
    "op10 passages": lambda d: paragraph_minhash.repeated_passages(d),
}


@pytest.mark.parametrize("name", EMPTY)
def test_empty_table_gives_no_rows(spark, name):
    assert EMPTY[name](frame(spark, [])).collect() == []


# 1: line dedup
def test_chain_is_a_longest_rising_run():
    rnd = random.Random(5)
    for _ in range(100):
        seconds = rnd.sample(range(12), 8)
        got = line_alignment._chain([(i, b, 0, 0, 0) for i, b in enumerate(seconds)])
        best = [1] * 8
        for i in range(8):
            best[i] += max((best[j] for j in range(i) if seconds[j] < seconds[i]), default=0)
        assert len(got) == max(best) and all(a[0] < b[0] and a[1] < b[1] for a, b in zip(got, got[1:]))


def test_patience_prefers_unique_lines_and_fills_gaps():
    entries = [(0, 5, 0, 9, 1), (1, 6, 1, 9, 7), (2, 7, 2, 9, 2), (3, 8, 3, 9, 7), (4, 0, 4, 9, 3)]
    assert [e[:2] for e in line_alignment.patience(entries)] == [(0, 5), (1, 6), (2, 7), (3, 8)]
    assert line_alignment.blocks(line_alignment.patience(entries), 5) == [0, 1, 2, 3]


def kept_lines(spark, rows, **limits):
    return {r.doc_id: r.text for r in line_alignment.dedup_lines(frame(spark, rows), **limits).collect()}


def test_a_block_of_lines_that_all_stand_elsewhere_is_found(spark):
    """The owners of the single lines are other documents; only the run of lines ties 4 to 5."""
    rows = [(1, "alpha beta\nown text of one"), (2, "gamma delta\nown text of two"), (3, "epsilon zeta\nown text of three")]
    block = "alpha beta\ngamma delta\nepsilon zeta"
    got = kept_lines(spark, [*rows, (4, f"start four\n{block}"), (5, f"start five\n{block}\nend five")])
    assert got[4] == f"start four\n{block}" and got[5] == "start five\nend five"
    rows = [(1, "alpha beta gamma\nown text of one"), (2, "delta epsilon zeta\nown text of two")]
    block = "alpha beta gamma\ndelta epsilon zeta"
    got = kept_lines(spark, [*rows, (4, f"start four\n{block}"), (5, f"start five\n{block}\nend five")])
    assert got[5] == "start five\nend five"


def test_a_block_of_many_documents_goes_and_a_frequent_line_with_it(spark):
    """The line alone would tie no two documents; within a pair that the block ties, it is aligned like any other."""
    line, block = "the common header of many documents", "first line of a block\nsecond line of a block"
    rows = [(i, f"{prose(i, 15, 400)}\n{line}\n{prose(1000 + i, 15, 400)}\n{block}") for i in range(70)]
    got = kept_lines(spark, rows)
    assert got[0] == rows[0][1] and all(got[i] == f"{prose(i, 15, 400)}\n{prose(1000 + i, 15, 400)}" for i in range(1, 70))


@pytest.mark.parametrize("rare", [3, 50])
def test_line_blocks_equal_all_pairs(spark, rare):
    """Every pair of documents with common evidence, by plain loops over all pairs; the earliest with a piece of evidence owns it."""
    rnd = random.Random(rare)
    pool = [" ".join(f"w{rnd.randrange(60)}" for _ in range(rnd.randint(1, 6))) for _ in range(40)]
    docs = []
    for i in range(60):
        text = [rnd.choice(pool) if rnd.random() < 0.5 else f"own {i} {k} words here" for k in range(rnd.randint(0, 12))]
        if docs and rnd.random() < 0.6:
            other = rnd.choice(docs)[1].split("\n")
            at, n = rnd.randrange(len(other)), rnd.randint(1, 5)
            text[rnd.randint(0, len(text)) : 0] = other[at : at + n]
        docs.append((i, "\n".join(text)))
    lines = {i: [(n, x) for n, x in enumerate(t.split("\n")) if x.strip()] for i, t in docs}
    evidence = {}
    for i, own in lines.items():
        text, size = [x for _, x in own], [len(x.split()) for _, x in own]
        runs = [(a, b) for a in range(len(own)) for b in range(a, len(own)) if sum(size[a : b + 1]) >= 5]
        # single lines, and runs that no run of two lines and more within them with the same first or last line makes needless
        least = {(a, b) for a, b in runs if a == b} | {(a, b) for a, b in runs if b > a and (b - a == 1 or (a, b - 1) not in runs or (a + 1, b) not in runs)}
        evidence[i] = {tuple(text[a : b + 1]) for a, b in least if a == b or len(set(text[a : b + 1])) > 1}
    holders = defaultdict(list)
    for i, found in evidence.items():
        for e in found:
            holders[e].append(i)
    want, firsts = {}, {}
    for i, text in docs:
        body = tuple(x.strip() for _, x in lines[i])
        if body in firsts and body:
            want[i] = ""
            continue
        firsts[body] = i
    live = [i for i, _ in docs if i not in want]
    for i in live:
        gone = set()
        for j in live:
            if j < i and any(min(h for h in holders[e] if h in live) == j and (len(e) > 1 or sum(h in live for h in holders[e]) <= rare) for e in evidence[i] & evidence[j]):
                numbered = lambda own: {(x, sum(y == x for _, y in own[:k])): (k, n) for k, (n, x) in enumerate(own)}
                a, b = numbered(lines[i]), numbered(lines[j])
                entries = [(a[k][0], b[k][0], a[k][1], len(k[0].split()), hash(k[0])) for k in a if k in b]
                gone |= set(line_alignment.blocks(line_alignment.patience(entries), line_alignment.MIN_WORDS))
        want[i] = "\n".join(x for n, x in enumerate(dict(docs)[i].split("\n")) if n not in gone)
    assert kept_lines(spark, docs, rare=rare) == want


def test_later_document_loses_shared_blocks(spark):
    a, b, c, d = (prose(s, 12) for s in range(4))
    common = "the common header of many documents"
    rows = [
        (2, f"{c}\n{a}\n{b}\n{d} tail"), (1, f"{a}\n{b}\nown line one of this document"), (3, f"{a}\n{b}\nown line one of this document"),
        (4, "short\nlines"), (5, None), (6, ""), (None, f"{d} tail"), (4, "short\nlines"), (9, " \n "), *((100 + i, f"{common}\n{prose(50 + i, 15)}") for i in range(60)),
    ]
    got = defaultdict(list)
    for r in line_alignment.dedup_lines(frame(spark, rows)).collect():
        got[r.doc_id].append(r.text)
        assert (r.spans, r.label) == ("y", 4)
    assert got[1] == [rows[1][1]] and got[2] == [f"{c}\n{d} tail"] and got[3] == [""] and got[4] == ["short\nlines"] * 2
    assert got[5] == [None] and got[6] == [""] and got[None] == [""] and got[9] == [" \n "]
    assert all(got[100 + i] == [rows[9 + i][1]] for i in range(60))  # a line of 60 documents is no evidence by itself


def test_members_of_a_large_group_are_found_without_rare_lines(spark):
    lines = [prose(s, 9) for s in range(5)]
    rows = [(i, "\n".join([*lines[:2], f"own {i} text of number {i}", *lines[2:]])) for i in range(80)]
    got = {r.doc_id: r.text for r in line_alignment.dedup_lines(frame(spark, rows)).collect()}
    assert got[0] == rows[0][1] and all(got[i] == f"own {i} text of number {i}" for i in range(1, 80))


@pytest.mark.parametrize("size", [50, 51, 120])
def test_short_passages_go_however_many_documents_have_them(spark, size):
    one, two = prose(1, 60, 400), [prose(2, 9), prose(3, 9)]
    rows = [(i, "\n".join([prose(1000 + i, 15, 4000), one, prose(2000 + i, 15, 4000), *two])) for i in range(size)]
    got = {r.doc_id: r.text for r in line_alignment.dedup_lines(frame(spark, rows)).collect()}
    assert got[0] == rows[0][1] and all(got[i] == "\n".join(rows[i][1].split("\n")[0:3:2]) for i in range(1, size))


# 2: personal data
BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def base_spans(text):
    out = []
    for k, (name, pattern) in enumerate(BASE):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            twice = [int(c) * (1 + i % 2) for i, c in enumerate(digits[::-1])]
            ok = {
                "email": lambda: True, "ip": lambda: all(int(x) < 256 for x in m.group().split(".")),
                "card": lambda: 14 <= len(digits) <= 19 and sum(x - 9 * (x > 9) for x in twice) % 10 == 0, "phone": lambda: 10 <= len(digits) <= 15,
            }[name]()
            if ok:
                out.append((m.start(), k, m.end(), name))
    return sorted(out)


def test_base_spans_and_digest(spark):
    odd = [
        "", None, "a@b.c_d@e.f x", "1.2.3.4.5.6.7.8", "1" * 4000 + " 4111 1111 1111 1111", " +1 (202) 555-0143-", "a" * 3000 + "@x.y",
        "é😀 a@b.co ñ 10.0.0.256 1.1.1.1\n+49 30 1234567 ", "@@", "+1+2345678901234", "999.1.1.1 0001.002.3.4", "a@b..c", "x@y.z.", "....@a.b",
        "-@-.-", "4111-1111-1111-1111 4111111111111111 ", "12 34 56 78 90 12 34",
    ]
    rnd = random.Random(2)
    odd += ["".join(rnd.choice("ab@.+- 0142\n😀") for _ in range(rnd.randint(0, 60))) for _ in range(150)]
    rows = [*enumerate(odd), (None, "z@q.org"), (2, odd[2])]
    got = pii_disclosure.find_personal_data(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for doc_id, text in rows:
        spans, r = base_spans(text or ""), by_id[doc_id]
        joined = ",".join(f"{n}:{s}:{e}" for s, _, e, n in spans)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[3] == n for x in spans) for n, _ in BASE]
        assert ",".join(x for x in r.spans.split(",") if x.split(":")[0] in dict(BASE)) == joined


def test_terms_that_reveal_an_entity(spark):
    rows = [(i, f"meet zanthor near {i} at jo@x.org please thanks") for i in range(3)] + [(10 + i, f"please thanks number {i} ordinary words") for i in range(40)]
    got = {r.doc_id: r.spans for r in pii_disclosure.find_personal_data(frame(spark, rows)).collect()}
    n, df_e, df_please = 43, 3, 43
    share = lambda c, df_t: math.log2(c * n / (df_t * df_e)) / math.log2(n / df_e)
    assert share(3, 3) == 1 and share(3, df_please) < 0.1
    assert got[0] == "removed:0:4,removed:5:12,removed:13:17,email:23:31" and got[10] == ""
    text = {r.doc_id: r.text for r in pii_disclosure.sanitise(frame(spark, rows)).collect()}
    assert text[0] == "   0 at [email] please thanks" and text[10] == rows[3][1]


def test_short_names_other_lines_and_other_mentions(spark):
    text = ["Kim\njo@x.org", "Meier, 12 Main Road, 4111 1111 1111 1111", "zorro al@b.co, bo@c.co", "李明 +49 30 1234567", "+1 202 555 0143\n\nAnn"]
    rows = [(10 * k + i, t) for k, t in enumerate(text) for i in range(3)] + [(100 + i, f"other main road words {i}") for i in range(60)]
    got = {r.doc_id: r.spans for r in pii_disclosure.find_personal_data(frame(spark, rows)).collect()}
    for k, (t, name) in enumerate(zip(text, ["Kim", "Meier", "zorro", "李明", "Ann"], strict=True)):
        assert f"removed:{t.index(name)}:{t.index(name) + len(name)}" in got[10 * k].split(",")
    assert got[100] == ""


def plain_disclosures(rows, reach=5):
    """(document, start, end) -> kind of the terms, by a search over all documents."""
    docs = {(i, t or "") for i, t in rows}
    n, of_entity, of_pair, of_term, places = len(docs), defaultdict(set), defaultdict(set), defaultdict(set), defaultdict(set)
    for doc in docs:
        text = doc[1]
        for w in re.findall(r"[^\W\d_]+", text.lower()):
            of_term[w].add(doc)
        for s, k, e, _ in base_spans(text):
            entity = k, text[s:e].lower()
            of_entity[entity].add(doc)
            runs = [m.span() for m in re.finditer(r"\S+", text)]
            before, after = [r for r in runs if r[1] <= s], [r for r in runs if r[0] >= e]
            own = [r for r in runs if r[0] < e and r[1] > s]
            begin = min([own[0][0], *(r[0] for r in before[-reach:])])
            end = max([own[-1][1], *(r[1] for r in after[:reach])])
            for a, b in ((begin, s), (e, end)):
                for m in re.finditer(r"[^\W\d_]+", text[a:b]):
                    if m.group() not in pii_disclosure.FUNCTION_WORDS:
                        of_pair[entity, m.group().lower()].add(doc)
                        places[doc, a + m.start(), a + m.end()].add((entity, m.group().lower()))
    out = {}
    for (doc, s, e), pairs in places.items():
        shares = []
        for entity, term in pairs:
            content = math.log2(n / len(of_entity[entity]))
            if len(of_pair[entity, term]) >= pii_disclosure.MIN_SUPPORT and content > 0:
                shares.append(math.log2(len(of_pair[entity, term]) * n / (len(of_term[term]) * len(of_entity[entity]))) / content)
        kind = "removed" if any(x >= pii_disclosure.REMOVE for x in shares) else "generalised" if any(x >= pii_disclosure.GENERALISE for x in shares) else None
        if kind and not any(s < b and e > a for a, _, b, _ in base_spans(doc[1])):
            out[doc, s, e] = kind
    return out


@pytest.mark.parametrize("times", [1, 2, 5])
def test_terms_equal_a_search_over_all_documents(spark, times):
    rnd, pool = random.Random(7), [*"abcdefgh", "Kim", "the", "the", "at", "ö" * 310, "x" * 500, "q,r", "12", "Meier's"]
    mentions = ["jo@x.org", "+49 30 1234567", "1.2.3.4", "<al@b.co>", "(jo@x.org)", "bo@c.co;"]
    rows = [(i, rnd.choice((" ", "\n", "  ")).join(rnd.choice(pool if rnd.random() < 0.85 else mentions) for _ in range(rnd.randint(0, 25)))) for i in range(120)]
    # names that go with a mention nearly always, often or at any distance
    rows += [(400 + i, " ".join([*rnd.choices(pool, k=rnd.randint(0, 4)), f"name{i % 8}".translate({48 + k: 103 + k for k in range(10)}), *rnd.choices(pool, k=rnd.randint(0, 6)), f"n{i % 8}@x.org"])) for i in range(60)]
    rows += [(500 + i, f"without name{i % 4}".translate({48 + k: 103 + k for k in range(10)})) for i in range(12)]
    rows += [(200 + i, "tied %s jo@y.org %s far" % ("w" * 25_000, "-" * 400)) for i in range(3)] + [(300, None), (None, "Kim jo@x.org")]
    want = {(*d, s, e, kind) for (d, s, e), kind in plain_disclosures(rows).items()}
    got = pii_disclosure.find_personal_data(frame(spark, rows * times)).collect()
    text = {i: t or "" for i, t in rows}
    assert {(r.doc_id, text[r.doc_id], x.s, x.e, pii_disclosure.KINDS[x.kind]) for r in got for x in r.found if x.kind >= len(BASE)} == want
    assert len(got) == times * len(rows) and any(x[0] == 201 and x[2] == 0 for x in want)
    assert Counter(x[4] for x in want)["removed"] > 20 and any(x[4] == "generalised" for x in want)


def test_mentions_in_one_run_take_linear_space(spark):
    row = pii_disclosure.base_mentions(frame(spark, [(1, "ann " + ",".join(f"a{i}@b.cd" for i in range(400)) + " bob")])).first()
    assert len(row.email) == 400 and max(len(m.left) + len(m.right) for m in row.email) < 200
    assert row.email[0].left == "ann " and row.email[399].right == " bob" and row.email[200].left.startswith(",a195@")


def test_personal_data_runs_without_python(spark):
    plan = pii_disclosure.find_personal_data(frame(spark, [(1, "a@b.cd")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# 3: token counts
def test_counts_equal_the_library(spark, rows):
    from tokenizers import Tokenizer, models

    small = [(x, -s / 1024) for x, s in (("<unk>", 9000), ("▁", 900), ("a", 1000), ("b", 1000), ("ab", 2000), ("▁a", 1900), ("▁ab", 2900), ("ba", 2000), ("aba", 3000), ("▁▁", 1800))]
    small += [(f"<0x{b:02X}>", -9.0) for b in range(256)]
    large = viterbi_counts.zipf_vocabulary(vocabulary_path("piece_bpe_32k.model"))
    rnd = random.Random(8)
    ties = ["".join(rnd.choice("aab  cé\n▁") for _ in range(rnd.randint(1, 14))) for _ in range(300)]
    for vocabulary, texts in ((small, ties), (large, ties[:50] + [t for _, t in rows if t])):
        library = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True))
        want = [len(library.encode("▁" + t.replace(" ", "▁")).ids) for t in texts]
        assert [n for _, n in viterbi_counts.Counter(vocabulary, cache_pieces=20).count(texts)] == want
    got = viterbi_counts.count_tokens(frame(spark, rows)).collect()
    assert len(got) == len(rows) and all(r.n_tokens == 0 and r.best_score == 0 for r in got if r.doc_id in (60, 61))
    with pytest.raises(ValueError):
        viterbi_counts.Counter([("a▁b", -1.0)])


# 4: benchmark decontamination
def test_items_are_found_reworded_by_their_slots_only(spark):
    ask = "Once upon a time {a} bought {x} apples for {y} dollars and then {a} sold {z} apples to {b} for 9 dollars, said {a} to {b}"
    item = ask.format(a="Alice", b="Bobby", x=3, y=5, z=2)
    docs = [
        (1, item), (2, "Some words before. " + ask.format(a="Zelda", b="Marko", x=33, y=7, z=12) + " and after"), (None, item.upper()), (4, None), (5, ""), (1, item),
        (6, "Once upon a time Zelda bought 33 apples for 7 dollars and then Hanna sold 12 apples to Zelda for 9 dollars, said Tommy to Peter"),
        (7, " ".join(item.split()[:9])), (8, prose(4, 80)), (9, "plain short item"), (10, "a plain short item here"), (11, item.replace(" ", " \n ")),
    ]
    items = spark.createDataFrame([(70, item, 1), (71, None, 1), (72, "", 1), (73, "plain short item", 1), (70, item, 2)], "item_id long, text string, share int")
    got = {(r.doc_id, r.item_id) for r in template_decontamination.contaminated(frame(spark, docs), items).collect()}
    assert {x for x in got if x[0] is not None} == {(1, 70), (2, 70), (11, 70), (9, 73), (10, 73)}


def held(spark, docs, items):
    items = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r.doc_id, r.item_id) for r in template_decontamination.contaminated(frame(spark, docs), items).collect()}


def test_names_at_the_start_of_sentences_are_placeholders(spark):
    long = "{} has {} apples in the basket. {} takes {} apples from it. {} buys {} more at the market. How many apples does \"{}\" have now?"
    short = "{} buys {} pens. {} buys {} pens. {} sells {} pens. How many pens are left?"
    docs = [
        (1, "Text before. " + long.format("Maria", 20, "Paul", 7, "Maria", 9, "Paul")), (2, short.format("Kim", 7, "Lea", 9, "Kim", 3)),
        (3, long.format("Anna", 12, "Ben", 3, "Anna", 5, "Ben")), (4, short.format("Kim", 7, "Lea", 9, "Jo", 3)), (5, "and so " + short.format("Tom", 4, "Sam", 6, "Tom", 8).lower()),
    ]
    assert held(spark, docs, [long.format("Anna", 12, "Ben", 3, "Anna", 5, "Ben"), short.format("Tom", 4, "Sam", 6, "Tom", 8)]) == {(1, 0), (3, 0), (2, 1), (5, 1)}


def test_items_of_few_plain_words_are_found_as_they_are(spark):
    items = ["Convert 5 km to miles", "12 + 7 = ?", "2 4 8 16 32 64 128 256", "1 2 3 4 5 6 7 8 9 then the plain words that follow here"]
    docs = [*((i, f"Some words before. {t} And some behind.") for i, t in enumerate(items)), (10, "Convert 6 km to miles"), (11, "13 + 7 = ?"), (12, "3 5 9 17 33 65 129 257")]
    assert held(spark, docs, items) == {(i, i) for i in range(4)}


def test_no_two_words_of_an_item_stand_for_one(spark):
    item = "the boxes of Alice weigh 3 kg less than those of Bobby while Carol keeps 4 of them and gives the rest of her own to Alice again"
    texts = [
        item.replace("Alice", "Xenia").replace("Bobby", "Yusuf").replace("Carol", "Zelda").replace("3", "8").replace("4", "9"),
        item.replace("Alice", "Zelda").replace("Bobby", "Zelda").replace("Carol", "Zelda"),  # all names alike
        item.replace("3", "7").replace("4", "7"),  # all numbers alike
        item.replace("to Alice", "to Bobby"),  # one name for two
        item,
    ]
    got = template_decontamination.contaminated(frame(spark, list(enumerate(texts))), spark.createDataFrame([(9, item)], "item_id long, text string")).collect()
    assert {r.doc_id: r.consistent for r in got} == {0: 1.0, 4: 1.0}


def test_templates_keep_the_number_of_words(spark, rows):
    from pyspark.sql import functions as F

    docs = frame(spark, [*rows, (1, "At 5:30 Bob paid 1,000.50 kg | -- 7% to Ann, 'Tom' (x9) U.S. ...")]).select(template_decontamination.spaced(F.col("text")).alias("t"))
    for r in docs.select("t", template_decontamination.template(F.col("t")).alias("u")).collect():
        assert len(r.t.split(" ")) == len(r.u.split(" "))


# 5: quality rules
def test_counts_of_quality_rules(spark, rows):
    twice = prose(1, 12)
    more = [*rows, (200, f"{twice} and {twice} x"), (201, "w " * 30), (202, "a\na\n \n \na b\na"), (203, "# $ %%\n<x>|*&")]
    model = np.zeros((line_crf.FEATURES, 2)), np.zeros((2, 2))
    got = {(r.doc_id, i): r for i, r in enumerate(sorted(line_crf.label_lines(frame(spark, more).coalesce(1), model).collect(), key=lambda r: repr(r.doc_id)))}
    texts = {repr(i): t or "" for i, t in more}
    for (doc_id, _), r in got.items():
        text = texts[repr(doc_id)]
        words = words_of(text)
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        times = Counter(windows)
        hit = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(8)}
        lines = [x for x in text.split("\n") if words_of(x)]
        failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit), failed, not failed)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) == want


def test_viterbi_is_the_best_path():
    rnd = np.random.default_rng(3)
    for n in range(1, 8):
        unary, pair = rnd.normal(size=(n, 2)), rnd.normal(size=(2, 2))
        value = lambda s: sum(unary[i, x] for i, x in enumerate(s)) + sum(pair[a, b] for a, b in zip(s, s[1:]))  # noqa: E731, B023
        best = max(range(2**n), key=lambda m: value([m >> i & 1 for i in range(n)]))  # noqa: B023
        assert line_crf.viterbi(unary, pair).tolist() == [best >> i & 1 for i in range(n)]


def test_field_separates_held_out_documents(spark):
    good = lambda s: "\n".join(prose((s, i).__repr__(), 14, 300).capitalize() + "." for i in range(4))
    bad = lambda s: "\n".join(" | ".join(prose((s, i).__repr__(), 14, 300).upper().split()) + " ###" for i in range(4))
    rows = [(i, good(i) if i % 2 else bad(i)) for i in range(160)]
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(80)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    model = line_crf.fit_on(docs, labels)
    verdict = {r.doc_id: r.kept for r in line_crf.label_lines(docs, model).collect()}
    assert sum(verdict[i] == bool(i % 2) for i in range(80, 160)) >= 78
    assert {r.doc_id for r in line_crf.keep_documents(docs, model).collect()} == {i for i, kept in verdict.items() if kept}


def test_training_sees_the_end_of_long_documents(spark):
    text = "\n".join(f"line number {i}" for i in range(3000)) + "\nlast words\nlast words"
    (x, y), = line_crf.training_sequences(frame(spark, [(1, text)]), spark.createDataFrame([(1, 1)], "doc_id long, quality int"))
    assert len(x) == len(y) <= 8 * line_crf.SAMPLE_LINES and y[-1] == 1 and not y[:-2].any()
    assert all(line_crf.spread_lines(n, 8).tolist() == list(range(n)) for n in (0, 1, 64, 65, 512))


# 6: language model
def brute_ppm(train, order, text):
    counts = defaultdict(Counter)
    for t in train:
        s = [256] * order + list(t) + [256]
        for i in range(order, len(s)):
            for j in range(order + 1):
                counts[tuple(s[i - j : i])][s[i]] += 1
    s, total = [256] * order + list(text) + [256], 0.0
    for i in range(order, len(s)):
        out, done = set(), False
        for j in range(order, -1, -1):
            left = {k: n for k, n in counts.get(tuple(s[i - j : i]), {}).items() if k not in out}
            if left:
                bottom = sum(left.values()) + len(left)
                if s[i] in left:
                    total, done = total + math.log10(left[s[i]] / bottom), True
                    break
                total, out = total + math.log10(len(left) / bottom), out | set(left)
        if not done:
            total -= math.log10(257 - len(out))
    return total


@pytest.mark.parametrize("order", range(6))
def test_trie_against_brute_force(order):
    rnd = random.Random(order)
    for _ in range(15):
        letters = b"abc \x00d"[: rnd.randint(1, 6)]
        text = lambda: bytes(rnd.choice(letters) for _ in range(rnd.randint(0, 25)))  # noqa: E731, B023
        train, tests = [text() for _ in range(rnd.randint(0, 6))], [text() + rnd.choice([b"", b"zz"]) for _ in range(5)]
        codes, n = ppm.count_codes(train, order) if train else (np.zeros(0, np.int64),) * 2
        want = [brute_ppm(train, order, t) for t in tests]
        assert np.allclose(ppm.Model(codes, n, order).log10(tests, chunk=rnd.choice([7, 1 << 20])), want)


@pytest.mark.parametrize("limits", [{}, {"entries": 2000, "frequent": 50}])
def test_scores_of_documents(spark, rows, limits):
    got = {(r.doc_id, r.n_tokens): r for r in lm_scoring.score_documents(frame(spark, rows), order=2, **limits).collect()}
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
    tokens = lambda t: [*words_of(low(t)), ""]
    train = [t for i, t in rows if not held(i)]
    counts = Counter(x for t in train for x in tokens(t))
    total, kinds = sum(counts.values()), len(counts)
    raw = [low(t).encode() for t in train]
    for i, t in rows:
        r, own = got[i, len(tokens(t))], tokens(t)
        assert (r.held_out, r.n_known, r.train_tokens) == (held(i), sum(counts[x] > 0 for x in own), total)
        assert math.isclose(r.base_score, sum(math.log10((counts[x] + 1) / (total + kinds + 1)) for x in own), rel_tol=1e-9)
    for i, t in rows[-8:]:
        assert math.isclose(got[i, len(tokens(t))].score, brute_ppm(raw, 2, low(t).encode()), rel_tol=1e-9)


# 7: near-duplicates
def test_each_pair_within_the_radius_meets_in_a_table():
    rnd = random.Random(1)
    masks = covering_simhash.covering_masks()
    assert len(masks) == 15
    for _ in range(20000):
        bits = sum(1 << b for b in rnd.sample(range(64), 3))
        assert any(bits & m == 0 for m in masks)


@pytest.mark.parametrize("bucket", [4096, 2])
def test_groups_against_all_pairs(spark, rows, bucket):
    import xxhash

    def mark(text):
        words = words_of(low(text))
        hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))] if words else []
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    marks = [(i, mark(t)) for i, t in rows]
    group = list(range(len(marks)))
    for _ in group:
        for i, (_, x) in enumerate(marks):
            for j, (_, y) in enumerate(marks):
                if (x ^ y).bit_count() <= 3:
                    group[i] = group[j] = min(group[i], group[j])
    least = {g: min((d for (d, _), h in zip(marks, group) if h == g and d is not None), default=None) for g in group}
    want = sorted(((d, f"{m:016x}", least[g]) for (d, m), g in zip(marks, group)), key=repr)
    docs = frame(spark, rows)
    got = covering_simhash.near_duplicates(docs, bucket=bucket)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got.collect()), key=repr) == want
    kept = covering_simhash.keep_first(docs, bucket=bucket).collect()
    assert len(kept) == len(set(group)) and {r.doc_id for r in kept} == set(least.values()) and kept[0].spans == "y"


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7), (None, 3), (500, 501), (501, 500)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "x long, y long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 130)}, 501: 500}


# 8 and 9: packing
def reference_ids(texts, end):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary_path(BPE))
    library.encode_special_tokens = True
    return [[*library.encode(t or "", add_special_tokens=False).ids, end] for t in texts]


def test_cached_ids_equal_the_library():
    rnd = random.Random(4)
    texts = ["".join(rnd.choice(" \n\t ab.1'é\r\x1c \x85日") for _ in range(rnd.randint(0, 12))) for _ in range(3000)]
    texts += [t or "" for _, t in corpus(3)] + ["it's I'LL\n", "x<|endoftext|> y", " ", "\n", "\na", " a", "a "]
    encoder = Encoder(vocabulary_path(BPE), cache_keys=64)
    got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)]
    assert [[*x, 7] for x in got] == reference_ids(texts, 7)


def test_words_with_signs_equal_the_library():
    encoder, random_ = Encoder(vocabulary_path(BPE), cache_keys=500), random.Random(5)
    letters = ["a", "tion", "é", "ß", "中", "ſ", "ª", "ʰ", "Ж", "½", "٣", "7", "_", "'s", "'ll", "\u0301", "\u200b", "🙂"]
    signs = ["", ",", ".", "!!", "'", "',", "|", "###", "’", "»", "'s", "'d,"]
    word = lambda: "".join(random_.choices(letters, k=random_.randint(0, 4))) + random_.choice(signs)
    texts = [random_.choice([" ", "\n"]).join(word() for _ in range(40)) for _ in range(200)]
    texts += [" ".join(word() + random_.choice(["", "\n"]) + word() for _ in range(30)) for _ in range(100)]
    texts += ["don't dogs' 'tis x''s rock'n'roll", "A" * 5000 + ",,,,", "\nfoo\nbar,\n'baz", "<|endoftext|> a<|endoftext|>b", "\x7f \x00b"]
    want = [np.array(x.ids, "<u4").tobytes() for x in encoder.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    assert encoder.encode(texts) == want == encoder.encode(texts)


@pytest.mark.parametrize("max_len", [2048, 8, 1])
def test_power_pieces_give_the_ids_back(spark, rows, max_len):
    pieces = pow2_packing.pack_powers(frame(spark, rows).coalesce(2), max_len=max_len).collect()
    want = {(i, len(x)): x for (i, _), x in zip(rows, reference_ids([t for _, t in rows], 1), strict=True)}
    found = defaultdict(lambda: defaultdict(set))
    for p in pieces:
        assert p.length & (p.length - 1) == 0 and p.length <= max_len and p.offset == 0 and p.ids_crc32 == zlib.crc32(p.ids)
        found[p.doc_id, p.doc_tokens][p.start].add(bytes(p.ids))
    assert len({p.sequence_id for p in pieces}) == len(pieces)
    assert sum(p.length for p in pieces) == sum(map(len, reference_ids([t for _, t in rows], 1)))
    for key, by_start in found.items():
        assert np.frombuffer(b"".join(next(iter(by_start[s])) for s in sorted(by_start)), "<u4").tolist() == want[key]
    with pytest.raises(ValueError):
        pow2_packing.pack_powers(frame(spark, rows), max_len=3)


def test_best_fit_equals_a_plain_search():
    rnd = random.Random(6)
    for _ in range(40):
        lengths, room, rows = [rnd.randint(1, 64) for _ in range(rnd.randint(0, 120))], [], bestfit_packing.best_fit
        for n in sorted(lengths, reverse=True):
            fits = [r for r in range(len(room)) if room[r] >= n]
            if fits:
                room[min(fits, key=room.__getitem__)] -= n
            else:
                room.append(64 - n)
        got = rows(lengths, 64)
        assert sorted(i for r in got for i in r) == list(range(len(lengths))) and sorted(64 - sum(lengths[i] for i in r) for r in got) == sorted(room)


@pytest.mark.parametrize("shard_ids", [4_000_000, 100])
def test_rows_of_the_matrix_give_the_documents_back(spark, rows, shard_ids):
    packed = bestfit_packing.pack_best_fit(frame(spark, rows).coalesce(2), row_len=32, shard_ids=shard_ids).collect()
    segments = []
    for r in packed:
        ids = np.frombuffer(r.ids, "<u2")
        assert len(ids) == 32 and r.cu_seqlens[-1] == r.n_ids and r.position_resets == r.cu_seqlens[:-1] and (ids[r.n_ids :] == 50256).all()
        segments += [(d, s, ids[a:b].tolist()) for d, s, a, b in zip(r.doc_ids, r.starts, r.cu_seqlens[:-1], r.cu_seqlens[1:], strict=True)]
    want = [(i, at, x[at : at + 32]) for (i, _), x in zip(rows, reference_ids([t for _, t in rows], 50256), strict=True) for at in range(0, len(x), 32)]
    assert sorted(segments, key=repr) == sorted(want, key=repr)
    assert len({r.row_id for r in packed}) == len(packed)


# 10: substring dedup
@pytest.mark.parametrize("limits", [{}, {"bucket": 2, "broadcast_texts": 0}])
def test_paragraphs_against_all_pairs(spark, limits):
    rnd, rows = random.Random(9), []
    for i in range(60):
        lines = []
        for _ in range(rnd.randint(0, 3)):
            words = prose(rnd.randrange(12), 60, 500).split()
            for _ in range(rnd.choice((0, 0, 1, 2, 6))):
                words[rnd.randrange(60)] = f"w{rnd.randrange(3)}"
            lines += [" ".join(words), "a short line"]
        rows.append((i, "\n".join(lines)))
    rows += [(None, rows[1][1]), (70, None), (71, ""), rows[2]]
    places = sorted({(i is None, i or 0, t, n) for i, t in rows if t for n, x in enumerate(t.split("\n")) if len(x.split()) >= 50})
    text_of = lambda p: p[2].split("\n")[p[3]].lower().split()
    sets = [{tuple(text_of(p)[k : k + 5]) for k in range(len(text_of(p)) - 4)} for p in places]
    group = list(range(len(places)))
    for _ in range(6):
        for i in range(len(places)):
            for j in range(i):
                if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                    group[i] = group[j] = min(group[i], group[j])
    want = sorted(
        ((None if p[0] else p[1], p[3], None if places[g][0] else places[g][1], places[g][3]) for i, (p, g) in enumerate(zip(places, group)) if i != g), key=repr
    )
    got = paragraph_minhash.repeated_paragraphs(frame(spark, rows), **limits).collect()
    assert sorted(((r.doc_id, r.line, r.kept_doc_id, r.kept_line) for r in got), key=repr) == want


def test_paragraphs_are_hashed_together(spark, monkeypatch):
    """Shingles and bands by their definition, word by word; the steps of a batch do not grow with its paragraphs."""
    rnd, op, mask = random.Random(6), paragraph_minhash, 2**64 - 1
    mixed = lambda x: int(op._mix(np.array([x & mask], np.uint64))[0])
    paragraphs = [[rnd.choice(b"a bb ccc d".split()) for _ in range(n)] for n in (60, 1, 0, 4, 5, 6, 200)]
    values, begins = op.shingles(paragraphs)
    keys = op.bands(values, begins)
    for words, found, own in zip(paragraphs, np.split(values, begins[1:]), keys.tolist(), strict=True):
        want = []
        for at in range(max(1, len(words) - 4)):
            value = 0
            for k, w in enumerate(words[at : at + 5]):
                value = (value * int(op.GOLDEN) + mixed(xxhash.xxh64_intdigest(w) + k)) & mask
            want.append(mixed(value))
        assert found.tolist() == want
        for b in range(op.BANDS):
            key = b
            for seed in op.SEEDS[b * op.ROWS : (b + 1) * op.ROWS].tolist():
                key = mixed(key * int(op.GOLDEN) + min(v * seed & mask for v in want))
            assert own[b] & mask == key
    calls, mix, run = [], op._mix, op.map_batches
    monkeypatch.setattr(op, "_mix", lambda x: calls.append(1) or mix(x))

    def here(df, make, schema, rows=500):
        if "bands" in schema:
            batch = {"doc": [b"d"] * 200, "doc_id": [1] * 200, "text": [prose(i, 60, 10**6) for i in range(200)]}
            assert sum(len(x["line"]) for x in make()(batch)) == 200 and len(calls) < 50
        return run(df, make, schema, rows)

    monkeypatch.setattr(op, "map_batches", here)
    op.repeated_paragraphs(frame(spark, [(1, prose(1, 60, 10**6))]))
    assert calls


@pytest.mark.parametrize("limits", [{}, {"broadcast_windows": 0, "task_places": 2}])
def test_passages_against_all_runs(spark, limits):
    """Every run of 50 words that an earlier place holds is met, nothing under 32 words is, and what goes is in the copy that stays."""
    rnd, rows = random.Random(4), []
    wrap = lambda words: "".join(w + rnd.choice((" ", " ", "  ", "\n", "\n\n", "\t")) for w in words)
    pool = [prose(900 + i, rnd.randint(45, 120), 10**6).split() for i in range(6)]
    for i in range(70):
        words = prose(i, rnd.randint(0, 80), 10**6).split()
        for _ in range(rnd.choice((0, 1, 1, 2))):
            at, run = rnd.randint(0, len(words)), rnd.choice(pool)
            cut = rnd.choice((0, 0, rnd.randint(0, len(run) - 20)))
            words[at:at] = [w.upper() for w in run[cut:]] if rnd.random() < 0.2 else run[cut:]
        rows.append((i, wrap(words)))
    rows += [(None, wrap(pool[0] + pool[1])), (80, None), (81, ""), (82, "ha " * 200), (83, " ".join(pool[2] + ["between"] + pool[2])), (84, "x " * 31), (85, "x " * 31), rows[3]]
    words_of = {i: (t or "").lower().split() for i, t in rows}
    order = sorted(words_of, key=lambda i: (i is None, i or 0))
    first = {n: {} for n in (32, 50)}
    for n, held in first.items():
        for i in order:
            for k in range(len(words_of[i]) - n + 1):
                held.setdefault(tuple(words_of[i][k : k + n]), (i, k))
    gone = defaultdict(set)
    got = paragraph_minhash.repeated_passages(frame(spark, rows), own_repeats=True, **limits).collect()
    for r in got:
        span = words_of[r.doc_id][r.word : r.word + r.n_words]
        assert len(span) == r.n_words and (r.n_words >= 32 or r.doc_id == r.kept_doc_id)
        assert words_of[r.kept_doc_id][r.kept_word] == span[0] and (order.index(r.kept_doc_id), r.kept_word) < (order.index(r.doc_id), r.word)
        gone[r.doc_id] |= set(range(r.word, r.word + r.n_words))
    assert sum(r.n_words for r in got) == sum(map(len, gone.values()))
    for i in order:
        old = {n: [first[n][tuple(words_of[i][k : k + n])] != (i, k) for k in range(len(words_of[i]) - n + 1)] for n in (32, 50)}
        allowed = {x for k, is_old in enumerate(old[32]) if is_old for x in range(k, k + 32)}
        assert gone[i] <= allowed
        if i != 82:  # a text that overlaps itself keeps its first window
            assert all(len(gone[i] & set(range(k, k + 50))) >= 32 for k, is_old in enumerate(old[50]) if is_old)
    assert gone[82] >= set(range(32, 182)) and not gone[84] and not gone[85]
    others = paragraph_minhash.repeated_passages(frame(spark, rows), **limits).collect()
    assert all(r.kept_doc_id != r.doc_id and set(range(r.word, r.word + r.n_words)) <= gone[r.doc_id] for r in others)
    assert {r.doc_id for r in others} == {r.doc_id for r in got if r.kept_doc_id != r.doc_id} and 82 not in {r.doc_id for r in others}


def test_windows_do_not_depend_on_what_is_around():
    rnd = np.random.default_rng(3)
    for _ in range(50):
        run = rnd.integers(0, 2**63, 50).astype(np.uint64)
        chosen = []
        for before, after in rnd.integers(0, 90, (2, 2)):
            at, h, g = paragraph_minhash.chosen_windows(np.concatenate([rnd.integers(0, 2**63, before).astype(np.uint64), run, rnd.integers(0, 2**63, after).astype(np.uint64)]))
            chosen.append({(x - before, y, z) for x, y, z in zip(at.tolist(), h.tolist(), g.tolist()) if before <= x <= before + 18})
            assert all(b - a <= 19 for a, b in zip(at.tolist(), at.tolist()[1:]))
        assert chosen[0] & chosen[1]


def test_decontamination_runs_no_python(spark):
    docs, items = frame(spark, [(1, "one two three four five six seven eight nine")]), spark.createDataFrame([(1, "one two three four five six seven eight nine")], "item_id long, text string")
    plan = template_decontamination.contaminated(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_windows_are_listed_for_touched_documents_only(spark):
    """A planted window is found at any place of a text; texts that share no block with an item go no further."""
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(5))
    items = [(1, " ".join(word() for _ in range(8))), (2, "one two three"), (3, "He met Anna Lee near 20 km of old road")]
    held = {i: " ".join([*(word() for _ in range(i)), items[0][1], *(word() for _ in range(11 - i))]) for i in range(9)}
    held[20], held[21] = "so one two three go", " ".join([word(), word(), "He met Otto Kern near 35 mi of old road", word()])
    docs = [*held.items(), *((100 + i, " ".join(word() for _ in range(40))) for i in range(30)), (200, None), (201, "")]
    frame, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    seen = []
    whole = template_decontamination.touched
    template_decontamination.touched = lambda keyed, item_windows: seen.append(whole(keyed, item_windows)) or seen[-1]
    try:
        got = template_decontamination.contaminated(frame, bench).collect()
    finally:
        template_decontamination.touched = whole
    assert {r.doc_id for r in seen[0].collect()} == set(held)
    assert {(r.doc_id, r.item_id) for r in got} == {*((i, 1) for i in range(9)), (20, 2), (21, 3)}
