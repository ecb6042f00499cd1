"""Operators on documents against plain Python twins, and on odd rows."""

import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from appmetrics.llm import batches, kd_shards, language_filters, mixing, pairwise_quality, pieces, repeats, simhash
from appmetrics.llm.queries import ORACLES, QUERIES, piece_model
from oracle import difference, spark_rows, sql_rows
from tests.llm import brute
from tests.llm.conftest import rows


def collected(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, small, name):
    assert difference(spark_rows(QUERIES[name](spark, small)), sql_rows(duck, ORACLES[name])) is None


# SentencePiece


def test_op2_matches_the_library(spark, small):
    library = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    want = {}
    for i, text in brute.documents(spark, small):
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        want[i] = (len(ids), brute.sha256(np.array(ids, "<u4").tobytes()), brute.sha256(library.decode(ids)))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op2_sentencepiece"](spark, small).collect()}
    assert got == want


def test_pieces_on_odd_rows(spark, odd, empty):
    library = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    got = pieces.encode(odd, piece_model(), parts=("ids", "begins", "ends", "decoded")).collect()
    want = Counter((r[0], tuple(library.encode(r[1] or "", add_bos=True, add_eos=True))) for r in rows())
    assert Counter((r.id, tuple(r.ids)) for r in got) == want
    texts = {tuple(library.encode(r[1] or "", add_bos=True, add_eos=True)): (r[1] or "").encode() for r in rows()}
    for r in got:
        text = texts[tuple(r.ids)]
        assert b"".join(text[b:e] for b, e in zip(r.begins, r.ends)) == text  # spans follow each other and cover all
        assert r.decoded == library.decode(list(r.ids))
    again = pieces.decode(pieces.encode(odd, piece_model(), parts=("ids",)), piece_model())
    assert again.filter("decoded IS NULL").count() == 0
    assert pieces.encode(empty, piece_model()).count() == 0


@pytest.mark.parametrize("text", ["", " ", "  ", " a", "a ", "a  b", "▁", "▁▁ a ", "\n", "a\n b\tc", "<s></s><unk>", "\0x", "<0x0A>", "ﬁ ½ ①", "a\u00a0b"])
def test_pieces_of_strange_texts(text):
    own = pieces.model(piece_model())
    assert own.encode([text])[0].tolist() == own.library.encode(text, add_bos=True, add_eos=True)


def test_pieces_name_their_source():
    own = pieces.model(piece_model())
    text = "Héllo  wörld\n😀"
    begins, ends = own.spans(text, own.encode([text])[0])
    for i, b, e in zip(own.encode([text])[0].tolist(), begins, ends):
        piece = own.library.id_to_piece(i)
        if not own.library.is_control(i) and not own.library.is_byte(i) and b > 0:
            assert text.encode()[b:e].decode() == piece.replace(pieces.SPACE, " ")


def double_array(words: dict[bytes, bytes]) -> bytes:
    """A compiled character map, built the plain way: every node's children at the first free block."""
    replacements, places = b"", {}
    for w, r in words.items():
        places[w] = len(replacements)
        replacements += r + b"\0"
    units, used = [0] * 4096, {0}

    def build(node, prefix):
        labels = sorted({w[len(prefix)] for w in words if w.startswith(prefix) and len(w) > len(prefix)} | ({0} if prefix in words else set()))
        if not labels:
            return
        base = next(b for b in range(1, 4096) if all((node ^ b) < 512 * 8 and (node ^ b ^ x) < 4096 and (node ^ b ^ x) not in used for x in labels) and b < 1 << 21)
        units[node] |= base << 10
        if prefix in words:
            units[node] |= 1 << 8
        children = {x: node ^ base ^ x for x in labels}
        used.update(children.values())
        for x, child in children.items():
            if x == 0:
                units[child] = places[prefix] | 1 << 31
            else:
                units[child] |= x
                build(child, prefix + bytes([x]))

    build(0, b"")
    packed = np.array(units, "<u4").tobytes()
    return np.array([len(packed)], "<u4").tobytes() + packed + replacements


def test_character_map_takes_the_longest_prefix():
    table = pieces.CharacterMap(double_array({b"a": b"1", b"ab": b"22", b"abc": b"", "ﬁ".encode(): b"fi"}))
    assert table.longest(b"abd", 0) == (2, b"22")
    assert table.longest(b"abc", 0) == (3, b"")
    assert table.longest(b"xa", 1) == (1, b"1")
    assert table.longest(b"x", 0) is None
    own = pieces.Model(piece_model())
    own.map = table
    text = "xﬁ abcab".encode()
    # x, f, i, space (three bytes), nothing, 2, 2
    assert own.alignment(text).tolist() == [0, 0, 0, 0, 1, 1, 4, 4, 4, 8, 8, 10]
    own.trims = True
    assert own.alignment(b"  x  y ").tolist() == [2, 2, 2, 2, 3, 3, 3, 5, 6]


# Mixing


def test_mix_comes_near_its_targets(spark, small):
    got = QUERIES["op3_mixing"](spark, small).toPandas()
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "source").toPandas().merge(got, on="doc_id")
    taken = docs.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), size=("size", "sum"), source_size=("source_size", "first"))
    assert (taken["size"] == taken["source_size"]).all()
    assert abs(taken["target"].sum() - got["size"].sum()) < 1e-6 * got["size"].sum()
    # Rounding to blocks, and a short last block in each of up to three passes.
    assert ((taken["taken"] - taken["target"]).abs() <= 4 * mixing.BLOCK_WORDS).all()
    assert (taken["target"] <= 3 * taken["source_size"] + 1e-9).all() and (got["taken"] <= 3 * got["size"]).all()


def test_mix_of_odd_rows(odd, empty):
    got = mixing.mix(odd)
    assert got.count() == len(rows())
    assert got.filter("taken < 0 OR taken > 3 * size OR (size = 0 AND taken > 0)").count() == 0
    assert got.filter("row.text IS NULL AND size <> 0").count() == 0
    assert collected(got.select("row.doc_id", "size", "taken").orderBy("doc_id", "size", "taken")) == collected(
        mixing.mix(odd.repartition(7)).select("row.doc_id", "size", "taken").orderBy("doc_id", "size", "taken")
    )
    parts = [r for g in got.collect() for r in g.parts]
    assert all(r.to > r["from"] and 1 <= r.shard <= mixing.SHARDS for r in parts)
    texts = mixing.mixed_documents(odd)
    assert texts.columns == odd.columns
    dotted = mixing.mixed_documents(odd.withColumnRenamed("text", "a.b").withColumn("c.d", F.lit(1)), text_col="a.b")
    assert dotted.columns == [{"text": "a.b"}.get(c, c) for c in odd.columns] + ["c.d"] and dotted.count() == texts.count()
    words = sum(len((r.text or "").encode().split()) for r in texts.collect())
    assert words == got.agg(F.sum("taken")).first()[0]
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0


def test_shards_take_their_quotas(spark):
    """Each shard has its quota of whole blocks of each source, no block a second time before all came once; reruns agree."""
    made = [(i if i % 5 else None, " ".join(f"w{i}x{j}" for j in range(16 * (1 + i % 3))), f"s{min(i % 7, 3)}") for i in range(420)]
    docs = spark.createDataFrame(made, "doc_id long, text string, source string")
    taken = mixing.mixed_documents(docs, chars_col=None, shard_col="shard")
    words = Counter((r.source, r.shard) for r in taken.collect() for _ in r.text.split())
    sizes = docs.groupBy("source").agg(F.sum(F.size(F.split("text", " "))).cast("long").alias("source_size")).withColumn("key", F.col("source"))
    targets = mixing.source_targets(sizes.select("key", "source", "source_size"))
    quotas = {(r.key, r.shard): r.quota for r in mixing.shard_quotas(targets).collect()}
    assert len({shard for _, shard in quotas}) == mixing.SHARDS
    assert words == Counter({k: 16 * n for k, n in quotas.items() if n})
    times = {(r.source, w): 0 for r in docs.collect() for w in r.text.split()}
    for r in taken.collect():
        for w in r.text.split():
            times[(r.source, w)] += 1
    for source in {s for s, _ in times}:
        seen = [n for (s, _), n in times.items() if s == source]
        assert max(seen) - min(seen) <= 1 and max(seen) <= 3
    again = mixing.mixed_documents(docs.repartition(5, "text"), chars_col=None, shard_col="shard")
    assert Counter(collected(again)) == Counter(collected(taken))


def test_quotas_are_sainte_lague(spark):
    votes = {"a": 53_000, "b": 24_000, "c": 23_000, "d": 7, "e": 0}
    sizes = spark.createDataFrame([(f"s{k}", k, v) for k, v in votes.items()], "key string, source string, source_size long")
    targets = sizes.selectExpr("*", "row_number() OVER (ORDER BY source) AS rank", "sum(source_size) OVER () AS total", "cast(source_size AS double) AS target")
    got = Counter()
    for r in mixing.shard_quotas(targets, block_words=1000, shards=4).collect():
        got[(r.shard, r.key[1:])] = r.quota
    for shard in range(1, 5):
        seats = sorted(((-v / (2 * q + 1), k) for k, v in votes.items() for q in range(200)))[: 100 * shard // 4]
        want = Counter(k for _, k in seats)
        assert {k: sum(got[(s, k)] for s in range(1, shard + 1)) for k in votes} == {k: want[k] for k in votes}


# SimHash


def test_op4_matches_brute_force(spark, small):
    docs = brute.documents(spark, small)
    prints = {i: brute.simhash(t) for i, t in docs}
    pairs = [(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    least = brute.least_reachable(list(prints), pairs)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op4_simhash_near_dedup"](spark, small).collect()}
    assert got == {i: (f"{p:016x}", least[i]) for i, p in prints.items()}


def test_links_lose_nothing(spark):
    """Chains and bunches of fingerprints a bit or two apart, and others three apart."""
    random = np.random.default_rng(3)
    values = set()
    for start in random.integers(0, 1 << 63, 40).tolist() + [0, (1 << 64) - 1]:
        for _ in range(25):
            values.add(start)
            for bit in random.choice(64, random.integers(1, 4), replace=False).tolist():
                start ^= 1 << bit
    values = sorted(values)
    pairs = [(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 2]
    want = brute.least_reachable(values, pairs)
    signed = [v - (1 << 64) if v >= 1 << 63 else v for v in values]
    found = simhash.links(spark.createDataFrame([(v,) for v in signed], "fingerprint long")).collect()
    assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= 2 for r in found if r.b == r.a) and found
    got = brute.least_reachable(values, [(r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in found])
    assert got == want


def test_simhash_of_odd_rows(odd, empty):
    got = collected(simhash.simhash_groups(odd))
    assert Counter(r[0] for r in got) == Counter(r[0] for r in rows())
    prints = {(r[0], r[1]): brute.simhash(r[1]) for r in rows()}
    assert Counter((i, f & (1 << 64) - 1) for i, f, _ in got) == Counter((r[0], prints[(r[0], r[1])]) for r in rows())
    assert {c for _, f, c in got if f == 0} == {0}  # null, empty and blank texts link
    assert simhash.simhash_groups(empty).count() == 0


# Substring dedup


def test_op6_matches_brute_force(spark, small):
    want = sorted((i, n, r, brute.sha256(k)) for i, n, r, k in brute.without_repeats(brute.documents(spark, small)))
    assert sorted(collected(QUERIES["op6_substring_dedup"](spark, small))) == want


@pytest.mark.parametrize("window,anchor", [(35, 8), (35, 35), (5, 2), (4, 1)])
def test_repeats_of_odd_rows(odd, empty, window, anchor):
    got = repeats.without_repeats(odd, window=window, anchor=anchor)
    want = Counter((n, r, k) for _, n, r, k in brute.without_repeats([r[:2] for r in rows()], window))
    assert Counter((r.n_words, r.n_removed, r.text) for r in got.collect()) == want
    assert repeats.without_repeats(empty, window=window, anchor=anchor).count() == 0


def test_repeats_are_maximal_ranges(spark):
    shared = [f"p{i}" for i in range(40)]
    docs = spark.createDataFrame([(1, " ".join(["x", *shared, "y"])), (2, " ".join(["z", "z", *shared]))], "doc_id long, text string")
    got = {r.row.doc_id: [(x.begin, x.end) for x in r.repeats] for r in repeats.without_repeats(docs).collect()}
    assert got == {1: [(1, 41)], 2: [(2, 42)]}
    kept = repeats.without_repeats(spark.createDataFrame([(1, " a  b ")], "doc_id long, text string"), verbatim=True).first()
    assert kept.text == " a  b "


# Sharding


def test_op5_law(spark, small):
    got = QUERIES["op5_kd_sharding"](spark, small).toPandas()
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").toPandas().merge(got, on="doc_id")
    assert len(docs) == len(got)
    assert all(zlib.crc32((t or "").encode()) == c and len((t or "").encode()) + 8 == s for t, c, s in zip(docs["text"], docs["text_crc32"], docs["size"]))
    by_shard = got.groupby("shard")
    assert set(by_shard.groups) <= set(range(24))
    assert all(sorted(g["slot"]) == list(range(len(g))) for _, g in by_shard)
    target = got["size"].sum() / 24
    assert (by_shard["size"].sum() - target).abs().max() <= max(0.1 * target, 1.5 * got["size"].max())


def test_kd_shards_split_a_large_group_of_copies(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "CASE WHEN id < 1500 THEN 'the same text' ELSE concat('text ', id) END AS text")
    got = kd_shards.kd_shards(docs, {"length": F.length("text")}, shards=7).toPandas()
    sizes = got.groupby("shard")["size"].sum()
    assert len(sizes) == 7 and sizes.max() <= 1.05 * sizes.min()


def test_kd_shards_of_odd_rows(odd, empty):
    dims = {"length": F.length("text"), "chars": F.col("n_chars"), "lang": kd_shards.code_order(F.col("lang"))}
    got = kd_shards.kd_shards(odd, dims, shards=5).toPandas()
    assert len(got) == len(rows()) and set(got["shard"]) <= set(range(5))
    assert all(sorted(g["slot"]) == list(range(len(g))) for _, g in got.groupby("shard"))
    by_size = kd_shards.kd_shards(odd, dims, target_bytes=200_000)
    assert by_size.agg(F.max("shard")).first()[0] >= 3
    assert kd_shards.kd_shards(empty, dims, shards=5).count() == 0


# Quality


def auc(scores, labels):
    ranks = scores.rank()
    ones = int((labels == 1).sum())
    return (ranks[labels == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(labels) - ones))


def test_op8_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op8_quality_ranking"](spark, sf).toPandas()
    assert len(got) == 1000 and got["score"].between(0, 1).all() and ((got["score"] >= 0.5) == (got["predicted"] == 1)).all()
    assert all((zlib.crc32(str(i).encode()) % 3 == 1) == h for i, h in zip(got["doc_id"], got["held_out"]))
    held = got[got["held_out"]].merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    assert auc(held["score"], held["quality"]) > 0.98
    assert held[held["quality"] == 1]["predicted"].mean() > 0.97


def test_quality_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(5, 1), (9, 1), (10, 1), (11, 0), (13, 0), (11, 0), (None, 1), (6, None), (7, 5)], "doc_id long, quality int")
    ranking = pairwise_quality.learn(odd, labels)
    got = pairwise_quality.score(ranking, odd)
    assert got.count() == len(rows()) and got.filter("score IS NULL OR isnan(score) OR score < 0 OR score > 1").count() == 0
    kept = pairwise_quality.keep(ranking, odd)
    assert kept.columns == odd.columns and kept.count() == got.filter("score >= 0.5").count()
    assert pairwise_quality.score(ranking, empty).count() == 0
    none = pairwise_quality.learn(empty, labels)
    assert pairwise_quality.score(none, odd).filter("score = 0.5").count() == len(rows())


def test_quality_is_learned_from_all_labelled_rows(spark):
    """The 6,000 rows of each class that come first by hash say one thing, the many others the contrary."""
    drawn = spark.range(24000).selectExpr("id", "cast(id % 2 AS int) AS quality", "xxhash64(id) AS draw")
    first = "row_number() OVER (PARTITION BY quality ORDER BY draw) <= 6000"
    rest = ", ".join(["0D"] * (2 * len(pairwise_quality.FEATURES) - 1))
    known = drawn.selectExpr("id", "quality", f"IF({first}, 0.25D, -1D) * (quality - 0.5D) + pmod(id, 7) / 100D AS x", f"array({rest}) AS rest")
    ranking = pairwise_quality.fit(known.selectExpr("id", "quality", "concat(array(x), rest) AS values"))
    assert ranking.weights[0] < 0


def test_quantiles_are_those_of_sql(spark):
    shares = [0.0, 0.1, 1 / 3, 0.5, 0.975, 1.0]
    for n in (1, 2, 11, 500):
        df = spark.range(n).selectExpr("double(pmod(hash(id), 37)) / 7 AS raw")
        want = df.selectExpr(f"percentile(raw, array({', '.join(f'{p!r}D' for p in shares)})) AS q").first()["q"]
        assert pairwise_quality.quantiles(df, "raw", shares) == pytest.approx(want, abs=1e-12)


# Language


def test_op10_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op10_language_id"](spark, sf).toPandas()
    held = got[got["held_out"]].merge(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").toPandas(), on="doc_id")
    assert len(got) == 1000 and got["score"].between(0, 1).all()
    assert (held["lang"] == held["lang_pred"]).mean() > 0.98


def test_language_of_odd_rows(spark, odd, empty):
    filters = language_filters.learn(odd)
    got = odd.select("text", language_filters.identify(filters, F.col("text")).alias("found")).select("text", "found.*").collect()
    assert len(got) == len(rows())
    for r in got:
        lettered = any(c.isalpha() for c in r.text or "")
        assert (r.lang == "und") == (not lettered) and 0 <= r.score <= 1
    nothing = language_filters.learn(empty)
    assert odd.select(language_filters.identify(nothing, F.col("text")).alias("f")).filter("f.lang <> 'und'").count() == 0


def test_filters_name_all_languages_of_an_ngram(spark):
    """More languages than a word of masks holds, and false positives within their rate."""
    docs = spark.createDataFrame([(f"l{i:03d}", "".join(chr(0x4E00 + 100 * i + j) for j in range(60)) + " common") for i in range(70)], "lang string, text string")
    filters = language_filters.learn(docs)
    assert filters.table.shape[1] == 70
    texts = [r.text[5:40] for r in docs.orderBy("lang").collect()]
    assert filters.decide(texts)[0] == [f"l{i:03d}" for i in range(70)]
    code, _ = language_filters.grams(["omm"])
    assert (filters.masks(code[1:2])[0] & 1).sum() == 70


def test_filters_against_counted_ngrams(spark, small):
    """Every n-gram is in the filters of every language that has it, up to its level; bits are those of plain counts."""

    def trigrams(text):
        edged = "".join(c if c.isalpha() else " " for c in f" {(text or '').lower()} ")
        return [edged[i - 1 : i + 2] for i in range(1, len(edged) - 1) if edged[i] != " "]

    docs = spark.read.parquet(f"{small}/documents.parquet").select("text", "lang")
    filters = language_filters.learn(docs)
    texts = [(r.text or "", r.lang) for r in docs.collect()]
    held: dict[str, Counter] = {}
    for text, lang in texts:
        if lang is not None:
            held.setdefault(lang, Counter()).update(trigrams(text))
    assert filters.languages == sorted(held)
    levels = {}
    for at, lang in enumerate(filters.languages):
        total = sum(held[lang].values())
        levels[lang] = {g: 1 + sum(n / total >= 4.0 ** (j - 10) for j in range(1, 8)) for g, n in held[lang].items()}
        codes = np.array([sum((c != " ") * ord(c) << 21 * (2 - i) for i, c in enumerate(g)) for g in levels[lang]], np.uint64)
        want = np.array([(1 << n) - 1 for n in levels[lang].values()])
        assert (filters.masks(codes)[:, at] & want == want).all()
    assert (filters.false_positives < 0.02).all()
    got, (names, scores) = filters.counts([t for t, _ in texts])[1], filters.decide([t for t, _ in texts])
    for i, (text, _) in enumerate(texts):
        own = trigrams(text)
        if not own:
            assert names[i] == "und"
            continue
        want = [sum(levels[lang].get(g, 0) for g in own) / len(own) / 8 for lang in filters.languages]
        assert np.allclose(got[i], want, atol=0.02)
        assert want[filters.languages.index(names[i])] >= max(want) - 0.02 and scores[i] == max(got[i])


def test_batches_are_bounded(spark):
    was = spark.conf.get(batches.SETTING)
    try:
        for given, want in (("64m", 8 << 20), ("67108864b", 8 << 20), ("1m", 1 << 20), ("1000", 1000)):
            spark.conf.set(batches.SETTING, given)
            batches.bound_batches(spark)
            assert batches.size_of(spark.conf.get(batches.SETTING)) == want
    finally:
        spark.conf.set(batches.SETTING, was)
