"""The operators against brute force, round trips and held-out accuracy, and their edge cases."""

import hashlib
import math
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil.llm import ann, lm, mixing, ngram_join, packing, pii, quality, secrets, topk, toxicity
from vigil.llm.common import Powers, byte_values, separators, slices, words

DATA = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Nulls, empty and blank texts, repeated rows, ties, a null id, a very long text.
EDGES = [
    (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n\t", "en", None, 3), (4, "one two", "en", "a", 7), (4, "one two", "en", "a", 7), (5, "ONE two", "en", "b", 7),
    (None, "a text without an id that is long enough", "en", "b", 40), (7, "word " * 30_000, "en", "b", 150_000), (8, "password = 'abcdef123' é", None, "b", 24),
]


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def remainder(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{DATA}/labels.parquet")


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_words_are_split_and_hashed_like_plain_python():
    import pyarrow as pa

    texts = ["One two", "", "two  ÉÉ", "x", " ", "two"]
    found = list(slices(pa.array(texts, pa.string()), most=6))
    assert sum(len(p.starts) for p in found) == len(texts)
    out = []
    for part in found:
        w = words(part, byte_values(lower=True), separators(), Powers())
        out += [list(w.hash[a:b]) for a, b in zip(w.bounds[:-1], w.bounds[1:], strict=True)]
    assert [len(x) for x in out] == [2, 0, 2, 1, 0, 1]
    assert out[0][1] == out[2][0] == out[5][0] and len({h for x in out for h in x}) == 4


# 1


def components(rows, width, percent):
    sets = []
    for _, text in rows:
        w = tokens(text)
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            k = len(sets[i] & sets[j])
            if k and 100 * k >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = defaultdict(lambda: math.inf)
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least[find(i)], doc_id)
    return {doc_id: (len(sets[i]), least[find(i)]) for i, (doc_id, _) in enumerate(rows)}


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_join_equals_brute_force(docs, width, percent):
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(docs, width, percent).collect()}
    assert found == components([(r.doc_id, r.text) for r in docs.collect()], width, percent)


def test_join_of_near_copies_and_short_texts(spark):
    random, base = np.random.default_rng(3), [f"w{i}" for i in range(60)]
    rows = []
    for i in range(300):  # copies with up to four words changed: some link, some do not
        w = list(base)
        for at in random.integers(0, 60, random.integers(0, 4)):
            w[at] = f"x{random.integers(0, 30)}"
        rows.append((i, " ".join(w)))
    rows += [(300 + i, " ".join(f"s{j}" for j in range(n))) for i, n in enumerate([1, 1, 2, 3, 4, 11, 12, 12, 13, 20, 21])]
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()}
    assert found == components(rows, 3, 90)


def test_join_edges(edges, empty):
    found = [(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(edges, 3, 90).collect()]
    assert len(found) == len(EDGES)
    assert {(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4)} <= set(found)
    assert sum(x == (4, 1, 4) for x in found) == 2
    assert [x[2] for x in found if x[0] is None] == [None]
    assert ngram_join.near_duplicates(empty, 3, 90).count() == 0
    kept = ngram_join.one_of_each(edges)
    assert kept.columns == edges.columns and 5 not in {r.doc_id for r in kept.collect()}


# 2


def spans(text):
    out = []
    for order, (kind, pattern, least) in enumerate((
        ("assign", r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6),
        ("access", r"(AKIA[A-Z0-9]+)", 20), ("hex", r"([0-9a-f]+)", 24),
    )):
        out += [(m.start(), order, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text or "") if len(m[m.lastindex]) >= least]
    return [x for *_, x in sorted(out)]


def test_base_secrets_equal_plain_regexes(spark, docs, edges):
    tricky = spark.createDataFrame([(50, "secret:token:abcdef API_KEY='a.b-c/d=' tokenx=abcdefg apikey==abcdef", "", "", 0), (51, "AKIA" + "B" * 16 + " 0" * 30 + " " + "ab" * 12 + "g" + "a" * 23, "", "", 0)], DOCS)
    found = secrets.scan(docs.unionByName(edges).unionByName(tricky)).collect()
    for r in found:
        ours = [f"{s.kind}:{s.start}:{s.stop}" for s in r.__getitem__("__spans") if s.order < 3]
        assert ours == spans(r.text)
    assert any(spans(r.text) for r in found)


def test_added_rules_and_trigram_queries(spark):
    texts = ["ghp_" + "a" * 36, "xoxb-" + "1" * 12, "-----BEGIN RSA PRIVATE KEY-----", "eyJ" + "a" * 12 + ".eyJ" + "b" * 12 + "." + "c" * 12, "ghp_ short"]
    df = spark.createDataFrame([(i, t, "", "", 0) for i, t in enumerate(texts)], DOCS)
    kinds = {r.doc_id: [s.kind for s in r.__getitem__("__spans") if s.order >= 3] for r in secrets.scan(df).collect()}
    assert kinds == {0: ["forge_token"], 1: ["chat_token"], 2: ["private_key"], 3: ["web_token"], 4: []}
    assert secrets.trigram_query("[0-9a-f]{24,}") is None
    assert secrets.trigram_query("abcd") == [frozenset({"abc", "bcd"})]
    assert {frozenset({"abx"}), frozenset({"aby"})} == set(secrets.trigram_query("ab[xy]"))


def test_redaction_removes_secrets_and_leaves_the_rest(spark, empty):
    df = spark.createDataFrame([(1, "é token = abcdef1 end", "", "", 21), (2, "clean", "", "", 5), (3, None, "", "", None)], DOCS)
    found = {r.doc_id: (r.text, r.n_chars) for r in secrets.redact(df).collect()}
    assert found == {1: ("é [SECRET] end", 14), 2: ("clean", 5), 3: (None, None)}
    assert secrets.redact(empty).columns == empty.columns and secrets.redact(empty).count() == 0


def test_redaction_takes_whole_keys_and_tokens(spark):
    body = "\n".join(["MIIEpAIBAAKCAQEA" + "xY+/" * 12] * 40)
    begin, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    texts = [
        f"a {begin}\n{body}\nab12=\n{end} z", f"a {begin}\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,0A\n\n{body}\n{end} z", f"a {begin}\n{body}\nab12=\nsome more words", f"a {begin} as a name only",
        "a " + (begin + "\n" + body + "\n" + end).replace("\n", "\\n") + " z", f"a {begin}\n{body}\n{end} b {begin}\n{body}\n{end} z", "a ghp_" + "a" * 400 + " z", "a xoxb-" + "1" * 400 + " z",
    ]
    found = {r.doc_id: r.text for r in secrets.redact(spark.createDataFrame([(i, t, "", "", 0) for i, t in enumerate(texts)], DOCS)).collect()}
    assert [found[i] for i in range(len(texts))] == ["a [SECRET] z", "a [SECRET] z", "a [SECRET]\nsome more words", "a [SECRET] as a name only", "a [SECRET] z", "a [SECRET] b [SECRET] z", "a [SECRET] z", "a [SECRET] z"]


def test_very_long_texts_with_secrets_are_scanned_and_redacted(spark):
    """10 MB of key lines with and without END, and of headers alone; DuckDB finds the same."""
    import duckdb

    begin, end, line = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----", "\n" + "aB3+" * 16
    texts = [f"a {begin}{line * 150_000}\n{end} z", f"a {begin}{line * 150_000}\nsome words - and more", f"{begin} a-b " * 3_000, f"a {begin}\nProc-Type: 4\nx-y{line * 9}\n{'-' * 4} {line}\n{end} z", "- " * 1_000_000 + "token = abcdef1"]
    df = spark.createDataFrame([(i, t, "", "", 0) for i, t in enumerate(texts)], DOCS)
    found = {r.doc_id: r.text for r in secrets.redact(df).collect()}
    assert [found[i] for i in range(5)] == ["a [SECRET] z", "a [SECRET]\nsome words - and more", "[SECRET] a-b " * 3_000, "a [SECRET] z", "- " * 1_000_000 + "[SECRET]"]
    duck = duckdb.connect()
    duck.register("documents", df.select("doc_id", "text").toArrow())
    assert {i: spans for i, spans in duck.execute(f"SELECT doc_id, spans FROM ({secrets.OP2_SQL}) WHERE doc_id <> 2").fetchall()} == {
        r.doc_id: r.spans for r in secrets.scan(df).filter("doc_id <> 2").select("doc_id", secrets.joined_spans(F.col("__spans")).alias("spans")).collect()}


def test_nothing_is_scanned(empty):
    assert secrets.scan(empty).count() == 0


# 3


def test_permutations_are_bijective_and_keyed():
    for size in (1, 2, 10, 97, 1000):
        assert sorted(pii.Feistel("a").permuted("k", size, i) for i in range(size)) == list(range(size))
    assert pii.Feistel("a").permuted("k", 10**9, 5) != pii.Feistel("b").permuted("k", 10**9, 5)


def test_pseudonyms_keep_format_validity_and_links(spark, edges, empty):
    text = "card 4279055890764913 or 4279 0558 9076 4913, not 4279055890764914; call +1 (359) 555-3724, mail a.B.19@mail9.example.com, ip 43.95.227.29, day 2021-02-28 or 28.02.2021, not 2021-02-30, ssn 123-45-6789, GB82WEST12345698765432"
    row = pii.pseudonymised(spark.createDataFrame([(1, text, "", "", 0)], DOCS)).first()
    kinds = Counter(v.kind for v in row.__getitem__("__values"))
    assert kinds == {"card": 2, "phone": 1, "email": 1, "ip": 1, "date": 2, "ssn": 1, "iban": 1}
    fresh = re.search(r"card (\d{16}) or (\d{4} \d{4} \d{4} \d{4}),", row.text)
    assert fresh[2].replace(" ", "") == fresh[1] != "4279055890764913" and pii.luhn_digit(fresh[1][:-1]) == fresh[1][-1]
    day = re.search(r"day (\d{4})-(\d\d)-(\d\d) or (\d\d)\.(\d\d)\.(\d{4})", row.text)
    assert day.groups()[:3] == day.groups()[:2:-1]
    assert "4279055890764914" in row.text and "2021-02-30" in row.text and "@mail9.example.com" in row.text
    assert re.sub(r"[A-Za-z0-9]+", "", row.text) == re.sub(r"[A-Za-z0-9]+", "", text)
    found = pii.pseudonymised(edges)
    assert [r.text for r in found.collect()] == [e[1] for e in EDGES]
    assert pii.pseudonymised(empty).count() == 0


def test_values_beside_other_digits_are_found():
    f = pii.Feistel("a")
    for text, kinds in (
        ("4111 1111 1111 1111 12/27", ["card"]), ("4111111111111111 123", ["card"]), ("27 4111 1111 1111 1111 é", ["card"]), ("2024-01-15 2024-01-16", ["date", "date"]), ("2024-01-15 555-123-4567", ["date", "phone"]),
        ("123-45-6789 555-123-4567", ["ssn", "phone"]), ("BE68 5390 0754 7034 EUR", ["iban"]), ("4279 0558 9076 4914", []), ("2021-02-30", []),
    ):
        fresh, found = pii.replaced(text, f)
        assert [k for k, *_ in found] == kinds
        assert all(text[a:b] not in fresh for _, a, b in found) and len(fresh) == len(text)
    fresh, found = pii.replaced("4111 1111 1111 1111 12/27", f)
    assert found == [("card", 0, 19)] and fresh.endswith(" 12/27")


def test_long_runs_are_read_once():
    f = pii.Feistel("a")
    for text, n in (("a." * 500_000, 0), ("a." * 500_000 + "@x.com", 1), ("a@" * 300_000, 0), ("1-" * 300_000, 0), ("GB82" * 200_000, 0)):
        began = time.perf_counter()
        assert len(pii.replaced(text, f)[1]) == n
        assert time.perf_counter() - began < 10


def test_pseudonyms_equal_a_plain_search(docs):
    """Every place of a text is tried for every kind in order, at each end from the longest."""
    mail = re.compile(r"\b[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}\b", re.ASCII)
    f = pii.Feistel(pii.DEMO_KEY)

    def plain(text):
        out, at = [], 0
        while at < len(text):
            for kind in pii.KINDS if text[at].isalnum() or text[at] in "+(" else ():
                match = (mail if kind == "email" else pii.ALONE[kind]).match(text, at)
                ends = range(match.end(), at, -1) if match and kind in pii.RUNS else [match.end()] if match else []
                for end in ends:
                    whole = kind not in pii.RUNS or (pii.ALONE[kind].fullmatch(text, at, end) and (end == match.end() or pii.RUNS[kind].match(text, end)))
                    fresh = pii.PSEUDONYM[kind](text[at:end], f) if whole else None
                    if fresh is not None:
                        out.append((kind, at, end, fresh))
                        break
                if out and out[-1][1] == at:
                    break
            at = out[-1][2] if out and out[-1][1] == at else at + 1
        return out

    texts = {r.doc_id: r.text for r in docs.collect() if r.text and re.search("[0-9@]", r.text)}
    n = 0
    for r in pii.pseudonymised(docs).collect():
        if r.doc_id in texts:
            values = plain(texts[r.doc_id])
            assert [(v.kind, v.start, v.stop) for v in r.__getitem__("__values")] == [v[:3] for v in values]
            parts, at = [], 0
            for _, a, b, fresh in values:
                parts, at = [*parts, texts[r.doc_id][at:a], fresh], b
            assert r.text == "".join([*parts, texts[r.doc_id][at:]])
            n += len(values)
    assert n


def test_addresses_of_any_length_are_replaced(spark):
    texts = ["a " + "x" * n + "@example.com b" for n in (63, 64, 65, 200, 5_000)] + ["a " + "ab.cd-" * 40 + "z@example.com", "a@b" * 20_000]
    found = pii.pseudonymised(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for r, t in zip(sorted(found), texts[:-1]):
        local, fresh = t[2 : t.index("@")], r.text[2 : r.text.index("@")]
        assert len(local) == len(fresh) and re.sub("[a-z]", "a", local) == re.sub("[a-z]", "a", fresh)
        assert all(local[i : i + 64] != fresh[i : i + 64] for i in range(0, len(local) - 8, 64)) and r.text[r.text.index("@") :] == t[t.index("@") :]
    f = pii.Feistel("k")
    assert len({pii.email(f"{'x' * n}{c}@e.com", f) for n in (3, 70) for c in "abcdef"}) == 12


# 4, 5


def held_out_rows(found, labels, name):
    known = {r.doc_id: r[name] for r in labels.collect()}
    return [(r.score, known[r.doc_id], r.predicted) for r in found.collect() if r.held_out and r.doc_id in known]


def test_quality_on_held_out_rows(spark):
    found = quality.op5_quality_score(spark, DATA)
    rows = held_out_rows(found, spark.read.parquet(f"{DATA}/labels.parquet"), "quality")
    assert sum(p == y for _, y, p in rows) >= 0.95 * len(rows)
    assert all(r.held_out == (remainder(r.doc_id, 3) == 1) for r in found.collect())


def test_quality_statistics_are_whole_and_density_is_right():
    import pyarrow as pa

    x = quality.statistics(pa.array(["Ab c!\nAb c!", None, ""], pa.string()), Powers())
    assert x.shape == (3, len(quality.STATISTICS)) and not x[1:].any()
    at = quality.STATISTICS.index
    assert x[0, at("upper")] == pytest.approx(math.sqrt(2 / 11)) and x[0, at("new_words")] == 0.5 and x[0, at("new_lines")] == 0.5
    model = quality.Discriminant([np.zeros(2), np.ones(2)], [np.eye(2), np.eye(2)], [0.0, 0.0], 0.5)
    assert model.score(np.array([[0.0, 0.0], [0.5, 0.5], [1.0, 1.0]])) == pytest.approx([1 / (1 + math.exp(1 / math.sqrt(2))), 0.5, 1 / (1 + math.exp(-1 / math.sqrt(2)))])


@pytest.mark.parametrize("module", [quality, toxicity])
def test_scores_of_edges_and_without_labels(spark, edges, empty, labels, module):
    for known in (labels, labels.limit(0), labels.filter("quality = 1 and toxic = 0"), spark.createDataFrame([(4, None, None)], "doc_id long, quality int, toxic int")):
        rows = module.score(edges, known).collect()
        assert len(rows) == len(EDGES) and all(0 <= r.score <= 1 for r in rows)
    assert module.score(empty, labels).count() == 0


def test_quality_filter_keeps_columns(docs, labels):
    kept = quality.kept(docs, labels)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()


def test_nearest_examples_are_exact():
    random = np.random.default_rng(5)
    idf = random.uniform(1, 5, 40)
    examples = [toxicity.Example(i, i % 2, np.sort(random.choice(40, random.integers(1, 8), replace=False))) for i in range(300)]
    index = toxicity.Index(examples, idf)
    dense = np.zeros((300, 40))
    for e in examples:
        dense[e.doc_id, e.terms] = toxicity.weighted(e.terms, idf)
    for _ in range(30):
        terms = np.sort(random.choice(40, random.integers(1, 8), replace=False))
        exact = dense[:, terms] @ toxicity.weighted(terms, idf)
        places, similar = index.nearest(terms, 10)
        order = [i for i in np.lexsort((np.arange(300), -np.round(exact, 12))) if exact[i] > 0][:10]
        assert index.ids[places].tolist() == order and similar == pytest.approx(exact[order])


def test_toxicity_equals_a_plain_cosine_vote(docs, labels):
    def terms(text):
        found = Counter()
        for w in re.findall(rb"[a-z0-9\x80-\xff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode()):
            found.update([(0, w), *((n, w[:n]) for n in toxicity.BEGINNINGS if len(w) > n)])
        return {(x, least) for x, n in found.items() for least in toxicity.LEVELS if n >= least}

    all_terms = {r.doc_id: terms(r.text) for r in docs.collect()}
    known = {r.doc_id: r.toxic for r in labels.collect() if r.toxic in (0, 1) and remainder(r.doc_id, 3) != 1}
    held = {c: Counter(t for i, x in known.items() if x == c for t in all_terms[i]) for c in (0, 1)}
    ones, zeros = sum(known.values()), len(known) - sum(known.values())
    often = Counter(t for x in all_terms.values() for t in x)
    weight = {}
    for t in held[0] | held[1]:
        a, b, n = held[1][t], held[0][t], ones + zeros
        chi = n * (a * (zeros - b) - b * (ones - a)) ** 2 / (ones * zeros * (a + b) * (n - a - b + 0.5))
        weight[t] = (math.log((1 + len(all_terms)) / (1 + often[t])) + 1) * max(1, chi / toxicity.LEAST)

    def unit(i):
        norm = math.sqrt(sum(weight[t] ** 2 for t in all_terms[i] if t in weight))
        return {t: weight[t] / norm for t in all_terms[i] if t in weight}

    examples = {i: unit(i) for i in known}
    prior = ones / len(known)
    share, voters = {}, {}
    for i in all_terms:
        own = unit(i)
        near = sorted((-round(sum(v * own.get(t, 0) for t, v in e.items()), 12), j) for j, e in examples.items() if j != i)[: toxicity.NEAREST]
        near = [(s, j) for s, j in near if s < 0]
        votes = [sum(s * s for s, j in near if known[j] == c) * (zeros, ones)[c] ** -1 * (1 - prior, prior)[c] * len(known) for c in (0, 1)]
        share[i], voters[i] = (votes[1] + toxicity.PRIOR_VOTES * prior) / (sum(votes) + toxicity.PRIOR_VOTES), [j for _, j in near]
    order = sorted(known)
    slope, shift = toxicity.calibration(np.array([share[i] for i in order]), np.array([float(known[i]) for i in order]), np.array([(1 - prior) * len(known) / zeros, prior * len(known) / ones])[[known[i] for i in order]])
    for r in toxicity.score(docs, labels).collect():
        if all_terms[r.doc_id]:
            assert sorted(r.evidence) == sorted(voters[r.doc_id])
            assert r.score == pytest.approx(1 / (1 + math.exp(-slope * toxicity.logit(share[r.doc_id]) - shift)), abs=1e-6)


def test_labels_of_missing_documents_and_repeated_labels_change_nothing(spark, docs, labels):
    strange = spark.range(3_000).select((F.col("id") + 10**9).alias("doc_id"), F.lit(1).alias("quality"), (F.col("id") % 2).cast("int").alias("toxic"))
    more = labels.select("doc_id", "quality", F.col("toxic").cast("int").alias("toxic"))
    more = more.unionByName(more).unionByName(strange.select("doc_id", F.col("quality").cast(labels.schema["quality"].dataType).alias("quality"), "toxic"))
    before, after = ({r.doc_id: (r.score, r.evidence) for r in toxicity.score(docs, x).collect()} for x in (labels, more))
    assert before == after


def test_quality_equals_a_plain_fit(docs, labels):
    import pyarrow as pa

    rows = docs.collect()
    x = quality.statistics(pa.array([r.text for r in rows], pa.string()), Powers())
    known = {r.doc_id: r.quality for r in labels.collect() if r.quality in (0, 1) and remainder(r.doc_id, 3) != 1}
    y = np.array([known.get(r.doc_id, -1) for r in rows])
    spread = [np.cov(x[y == c].T, bias=True) for c in (0, 1)]
    pooled = np.diag(sum((y == c).sum() * np.diag(spread[c]) for c in (0, 1)) / (y >= 0).sum())
    log = []
    for c in (0, 1):
        full = (1 - quality.SHRINK) * spread[c] + quality.SHRINK * pooled + quality.RIDGE * np.eye(x.shape[1])
        away = x - x[y == c].mean(axis=0)
        log.append(np.log((y == c).sum() / (y >= 0).sum()) - 0.5 * np.linalg.slogdet(full)[1] - 0.5 * np.einsum("ij,jk,ik->i", away, np.linalg.inv(full), away))
    scores = 1 / (1 + np.exp(-np.clip((log[1] - log[0]) / math.sqrt(x.shape[1]), -500, 500)))
    found = {r.doc_id: r.score for r in quality.score(docs, labels).collect()}
    assert [found[r.doc_id] for r in rows] == pytest.approx(scores.tolist(), abs=1e-5)


def test_toxicity_on_held_out_rows(spark):
    found = toxicity.op4_toxicity_score(spark, "/root/testdata/sf0.01")
    rows = held_out_rows(found, spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "toxic")
    assert sum(p == y for _, y, p in rows) >= 0.93 * len(rows)
    assert sum(p and not y for _, y, p in rows) <= 2
    assert sum((s - y) ** 2 for s, y, _ in rows) <= 0.06 * len(rows)


# 6, 10


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


BAD = [(1000, None, 0), (1001, [1.0, None, 0.0, 0.0], 0), (1002, [float("nan"), 0.0, 0.0, 0.0], 0), (1003, [], 0), (None, [1.0, 0.0, 0.0, 0.0], 0), (1004, [1.0, 2.0], 0)]


def test_top_k_equals_brute_force_with_ties(spark):
    random = np.random.default_rng(1)
    x = random.integers(-3, 4, (400, 4)) / 8
    df = vectors(spark, [(i, [float(c) for c in v], 0) for i, v in enumerate(x)] + BAD)
    found = defaultdict(list)
    for r in topk.top_k(df, every=100, k=10).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.rank, r.vec_id, r.score))
    y = np.floor(1024 * x.astype(np.float32).astype(float))
    for q in (0, 100, 200, 300):
        s = y @ y[q]
        order = [i for i in np.lexsort((np.arange(400), -s)) if i != q][:10]
        assert found[q] == [(n + 1, i, int(s[i])) for n, i in enumerate(order)]
    assert topk.top_k(df.limit(0), 100, 10).count() == 0
    everyone = topk.top_k(df.filter("vec_id < 400").withColumn("vec_id", F.col("vec_id") * 100), 100, 10)  # all ids are queries
    assert everyone.count() == 4_000 and {(r.rank, r.vec_id // 100, r.score) for r in everyone.filter("query_id = 10000").collect()} == set(found[100])
    assert topk.top_k(df.filter("vec_id < 3"), 100, 10).count() == 2


def test_segment_bounds_never_cut():
    random = np.random.default_rng(2)
    q, x = random.normal(size=(20, 30)), random.normal(size=(200, 30))
    for segments in (1, 4, 8, 16, 30):
        assert (topk.upper_bounds(q, x, segments) >= q @ x.T - 1e-9).all()


def test_recall_of_learned_partitions(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = df.collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=float)
    found = defaultdict(list)
    for r in ann.search(df, every=20, k=20).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, r.score))
    hit = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        s = x @ x[i]
        s[i] = -np.inf
        hit += len({v for v, _ in found[ids[i]]} & set(ids[np.lexsort((ids, -s))[:20]]))
        total += 20
        assert len(found[ids[i]]) == 20 and [b for _, b in found[ids[i]]] == pytest.approx(sorted((s[np.flatnonzero(ids == v)[0]] for v, _ in found[ids[i]]), reverse=True))
    assert hit >= 0.9 * total


def test_learned_partitions_edges(spark):
    df = vectors(spark, [(i, [1.0, float(i % 3), 0.0, 0.0], 0) for i in range(30)] + BAD + [(1005, [0.0] * 4, 0)])
    found = ann.search(df, every=20, k=20).collect()
    assert {r.query_id for r in found} == {0, 20} and len(found) == 40
    assert ann.search(df.limit(0), 20, 20).count() == 0
    graph = ann.neighbour_graph(np.random.default_rng(0).normal(size=(200, 5)), 10)
    assert np.bincount(ann.balanced_parts(graph, 8), minlength=8).max() <= math.ceil(1.1 * 200 / 8)


# 7


def check_packing(rows, texts, most=1024):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.vocabulary_path("byte_bpe_50k.json"))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for doc_id, parts in by_doc.items():
        ids = np.array([*tokenizer.encode(texts[doc_id] or "", add_special_tokens=False).ids, 2], dtype="<u4")
        parts.sort(key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(len(parts))) and sum(r.length for r in parts) == len(ids)
        assert all(r.length == most for r in parts[1:]) and (len(parts) == 1) == (len(ids) <= most)
        assert all(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in parts)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= most
    return len(by_sequence), sum(r.length for r in rows) / most


def test_packing_round_trip(docs, edges, empty):
    n, least = check_packing(packing.pack(docs).collect(), {r.doc_id: r.text for r in docs.collect()})
    assert n <= 1.03 * least + 2
    distinct = edges.dropDuplicates(["doc_id"])
    check_packing(packing.pack(distinct).collect(), {r.doc_id: r.text for r in distinct.collect()})
    assert packing.pack(empty).count() == 0


def test_texts_of_one_character_a_million_times(spark):
    texts = {1: " " * 1_000_000, 2: "\n" * 3_000_000, 3: "a" * 1_000_000, 4: "x" + " " * 2_000_000 + "y"}
    rows = packing.pack(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    check_packing(rows, texts)


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_holds(rule):
    lengths = np.random.default_rng(0).integers(1, 1024, 500)
    capacity = packing.Capacity(documents=3, attention=400_000, weights=(1.0, 0.5, 0.5), rule=rule)
    lengths = lengths[lengths**2 <= capacity.attention]
    order, bins, offsets = packing.best_fit(lengths, capacity)
    for b in range(bins.max() + 1):
        own = lengths[order[bins == b]]
        assert own.sum() <= 1024 and len(own) <= 3 and (own.astype(float) ** 2).sum() <= 400_000
        assert sorted(offsets[bins == b]) == sorted(np.cumsum([0, *own[np.argsort(offsets[bins == b])]])[:-1])


# 8


def test_mix_targets_and_copies(spark, edges, empty):
    rows = [(i, "w " * (i % 7 + 1), "en", f"s{i % 3}" if i % 50 else None, 0) for i in range(3000)]
    found = mixing.mix(spark.createDataFrame(rows, DOCS)).collect()
    by = defaultdict(lambda: [0, 0, 0.0])
    for r in found:
        size, copies = r.__getitem__("__size"), r.__getitem__("__copies")
        assert size == len((r.text or "").split()) and 0 <= copies <= 2
        b = by[r.source]
        b[0], b[1], b[2] = b[0] + size, b[1] + size * copies, r.__getitem__("__target")
    assert sum(b[2] for b in by.values()) == pytest.approx(1.5 * sum(b[0] for b in by.values()))
    assert all(b[2] <= 2 * b[0] + 1e-6 and abs(b[1] - b[2]) <= 0.1 * b[2] for b in by.values())
    assert by["s0"][2] == 2 * by["s0"][0]
    u = int(hashlib.md5(b"mix-1:17").hexdigest()[:13], 16) / 2**52
    rate = next(b[2] / b[0] for s, b in by.items() if s == "s2")
    assert next(r.__getitem__("__copies") for r in found if r.doc_id == 17) == math.floor(rate) + (u < rate - math.floor(rate))
    assert mixing.mix(edges).count() == len(EDGES) and mixing.emitted(edges).columns == edges.columns
    assert mixing.mix(empty).count() == 0 and mixing.emitted(edges.filter("text is null")).count() == 0


# 9


def test_language_model_scores(docs):
    found = {r.doc_id: r for r in lm.score(docs).collect()}
    rows = [(r.doc_id, [*tokens(r.text), 0]) for r in docs.collect()]
    count = Counter(w for i, x in rows if remainder(i, 10) for w in x)
    n, v = sum(count.values()), len(count)
    held, better = [], 0.0
    for i, x in rows:
        r = found[i]
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in x), rel=1e-9)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (remainder(i, 10) == 0, len(x), sum(count[w] > 0 for w in x), n)
        if r.held_out:
            held.append(i)
            better += r.score - r.base_score
    assert held and better > 0


def test_language_model_looks_up_what_is_not_broadcast(docs, monkeypatch):
    whole = {r.doc_id: (r.base_score, r.n_known) for r in lm.score(docs).collect()}
    monkeypatch.setattr(lm, "HEAD", 100)
    monkeypatch.setattr(lm, "DISHES", 20)
    part = {r.doc_id: (r.base_score, r.n_known) for r in lm.score(docs).collect()}
    assert all(part[i][1] == whole[i][1] and part[i][0] == pytest.approx(whole[i][0]) for i in whole)


def test_model_is_a_distribution_and_stirling_numbers_are_right():
    s = lm.stirling(0.5)
    row = {0: 1.0}
    for c in range(12):  # S(c + 1, t) = S(c, t - 1) + (c - t d) S(c, t)
        row = {t: row.get(t - 1, 0) + (c - 0.5 * t) * row.get(t, 0) for t in range(c + 2)}
    assert [math.exp(s[12, t]) for t in range(1, 13)] == pytest.approx([row[t] for t in range(1, 13)], rel=1e-4)
    room = lm.Restaurant(np.array([5.0, 1.0, 9000.0]), (0.6, 2.0), s, 1)
    parent = np.full(10, 0.1)
    for _ in range(5):
        room.sweep(parent[:3])
        assert (room.t >= 1).all() and (room.t <= room.c).all()
    assert room.predictive(parent, np.arange(3)).sum() == pytest.approx(1)


def seated_one_by_one(customers, discount, concentration, parent, sweeps):
    """Mean tables of each dish, customers leaving and coming back one at a time."""
    random, sizes, out = np.random.default_rng(1), [[n] for n in customers], np.zeros(len(customers))
    for sweep in range(-100, sweeps):
        for dish, n in enumerate(customers):
            for _ in range(n):
                at = random.choice(len(sizes[dish]), p=np.array(sizes[dish]) / n)
                sizes[dish][at] -= 1
                sizes[dish] = [x for x in sizes[dish] if x]
                chances = np.array([x - discount for x in sizes[dish]] + [(concentration + discount * sum(map(len, sizes))) * parent[dish]])
                at = random.choice(len(chances), p=chances / chances.sum())
                sizes[dish] = [*sizes[dish], 1] if at == len(sizes[dish]) else [x + (i == at) for i, x in enumerate(sizes[dish])]
        out += [len(x) for x in sizes] if sweep >= 0 else [0] * len(sizes)
    return out / sweeps


@pytest.mark.parametrize("tabulated", [512, 8])
def test_tables_are_those_of_a_plain_seating(monkeypatch, tabulated):
    monkeypatch.setattr(lm, "CUSTOMERS", tabulated)
    customers, parent = [6, 3, 1, 25], np.array([0.1, 0.3, 0.05, 0.2])
    room, mean = lm.Restaurant(np.array(customers, dtype=float), (0.75, 5.0), lm.stirling(0.75), 1), np.zeros(4)
    for sweep in range(-50, 3000):
        room.sweep(parent)
        mean += room.t / 3000 if sweep >= 0 else 0
    assert mean == pytest.approx(seated_one_by_one(customers, 0.75, 5.0, parent, 1000), rel=0.08)


def test_limit_of_many_customers_is_that_of_stirling_numbers(monkeypatch):
    monkeypatch.setattr(lm, "CUSTOMERS", 1200)
    t = np.arange(1, 1201)
    for rate in (3.0, 40.0, 500.0):
        weight = lm.stirling(0.6)[1200, 1:] + t * math.log(0.6 * rate)
        p = np.exp(weight - weight.max())
        drawn = lm.Restaurant(np.ones(1), (0.6, 1.0), None, 1).of_many(np.full(20_000, 1200.0), np.full(20_000, rate))
        assert drawn.mean() == pytest.approx((p * t).sum() / p.sum(), rel=0.02)


def test_scores_are_those_of_the_averaged_model(docs, monkeypatch):
    """The sum over a text's tokens of the model's probability, and of the word's share of its dish, by plain loops."""
    models = []
    monkeypatch.setattr(lm, "sampled", lambda counts, width, own=lm.sampled: models.append(own(counts, width)) or models[-1])
    monkeypatch.setattr(lm, "DISHES", 50)
    rows = docs.limit(60).collect()
    some = docs.sparkSession.createDataFrame([(r.doc_id, r.text) for r in rows], "doc_id long, text string")
    found = {r.doc_id: r.score for r in lm.score(some).collect()}
    assert np.allclose((10.0 ** models[0].astype(float)).sum(axis=1), 1, atol=1e-4)
    train = Counter(w for r in rows if remainder(r.doc_id, 10) for w in tokens(r.text))
    size = lambda w: min(len(w.encode()), lm.CLASSES) - 1
    least = sorted(train.values(), reverse=True)[49]
    if sorted(train.values(), reverse=True)[50] < least:  # no tie at the last dish
        dishes = {w for w, n in train.items() if n >= least}
        hashed = {}
        import pyarrow as pa
        for w in dishes:
            hashed[w] = next(lm.word_keys(pa.array([w], pa.string()), Powers()))[0][0]
        place = {w: i for i, w in enumerate(sorted(dishes, key=hashed.get))}
        rest = Counter({k: 0 for k in range(lm.CLASSES)})
        kinds = Counter()
        for w, n in train.items():
            if w not in dishes:
                rest[size(w)] += n
                kinds[size(w)] += 1
        for r in rows:
            at, total = 50 + lm.CLASSES, 0.0
            for w in [*tokens(r.text), None]:
                to = 50 + lm.CLASSES if w is None else place.get(w, 50 + size(w))
                total += models[0][at, to]
                if w is not None and w not in place:
                    total += math.log10((train[w] + 0.1) / (rest[size(w)] + 0.1 * (kinds[size(w)] + 1)))
                at = to
            assert found[r.doc_id] == pytest.approx(total, rel=1e-5)


def test_language_model_edges(edges, empty):
    rows = lm.score(edges).collect()
    assert len(rows) == len(EDGES) and all(math.isfinite(r.score) and r.score <= 0 for r in rows)
    assert [r.n_tokens for r in rows if r.doc_id in (1, 2, 3)] == [1, 1, 1]
    assert lm.score(empty).count() == 0


# the pipeline


def test_pipeline_stages(spark, docs):
    import corpus_pipeline

    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, DATA)
        assert after.count() > 0
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == docs.columns
            before = after
    assert not any(spans(r.text) for r in corpus_pipeline.secret_redaction(spark, docs, DATA).collect())


CLASHING = ("__doc_id", "__row", "__spans", "__kinds", "__size", "__source", "__source_size", "__target", "__rate", "__copies", "__copy", "__label", "__values", "__class", "component_id", "token", "node", "group", "shard", "score")


def test_stages_keep_columns_whose_names_clash(spark, edges, labels):
    import corpus_pipeline

    wide = edges
    for name in CLASHING:
        wide = wide.withColumn(name, F.concat(F.lit(f"{name}:"), F.col("doc_id").cast("string")))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, wide, DATA)
        assert after.columns == wide.columns, name
        assert all(r[c] == (None if r.doc_id is None else f"{c}:{r.doc_id}") for r in after.collect() for c in CLASHING)
    for run in (packing.pack, lm.score, pii.pseudonymised, mixing.mix, secrets.scan, lambda x: ngram_join.near_duplicates(x, 3, 90), lambda x: quality.score(x, labels), lambda x: toxicity.score(x, labels)):
        assert run(wide).count() >= len(EDGES)
    numbers = spark.range(60).selectExpr("id as vec_id", "array(cast(id % 7 as float), 1f) as embedding", "id as query_id", "id as rank", "id as score", "id as part", "id as block", "id as __x")
    assert topk.top_k(numbers, 20, 5).count() == 15 and ann.search(numbers, 20, 5).count() == 15


def test_searches_of_repeated_ids(spark):
    df = vectors(spark, [(i // 2, [1.0, float(i % 5), 0.5, 0.0], 0) for i in range(80)])
    for found in (topk.top_k(df, 20, 5), ann.search(df, 20, 5)):
        assert all(r.vec_id != r.query_id for r in found.collect()) and found.count() > 0


def test_pipeline_equals_its_stages_one_after_the_other(spark, tmp_path):
    import corpus_pipeline

    ids = lambda df: sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in df.collect())
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    scored = {r.doc_id: r.score for r in quality.score(docs, spark.read.parquet(f"{DATA}/labels.parquet")).collect()}
    rows = [r for r in docs.collect() if scored[r.doc_id] >= 0.5]
    whole = components([(r.doc_id, r.text) for r in rows], 5, 80)
    rows = [r for r in rows if whole[r.doc_id][1] == r.doc_id]
    left = spark.createDataFrame(rows, docs.schema)
    redacted = {r.doc_id: r.text for r in secrets.redact(left).collect()}
    assert set(redacted) == {r.doc_id for r in rows} and all(not spans(x) for x in redacted.values())
    copies = {r.doc_id: r.__getitem__("__copies") for r in mixing.mix(left.drop("text", "n_chars").join(spark.createDataFrame(list(redacted.items()), "doc_id long, text string"), "doc_id")).collect()}
    packed = [r for r in ids(corpus_pipeline.run(spark, DATA))]
    assert Counter(i for i, piece, *_ in packed if piece == 0) == Counter({i: n for i, n in copies.items() if n})


def test_pipeline_stages_take_edges_and_nothing(spark, edges, empty):
    import corpus_pipeline

    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, edges, DATA).count() >= 0
        assert stage(spark, empty, DATA).count() == 0
