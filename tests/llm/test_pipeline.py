"""The pipeline against plain Python, stage by stage, and on odd tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
from eventide.session import listed, shared_dir
from eventide.llm.mixing import BLOCK_ROWS, OTHER_WEIGHT, WEIGHTS

from .test_decontaminate import brute_tiles
from .test_neardup import brute as brute_components
from .test_rules import brute as brute_counts

SF = "/root/testdata/sf0.001"
SLACK = {"symbols": 0.10, "marks": 0.15, "upper": 0.10, "dup_lines": 0.50, "repeats": 0.40, "length": 3.0}
PUNCTUATION = "".join(chr(b) for b in range(33, 127) if not chr(b).isalnum())


def ratios(text):
    words, chars, symbols, dups, repeats = brute_counts(text)
    lines = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) for x in text.split("\n"))
    marks, upper = len(re.findall(r"[!?;:=\\/{}\[\]()_^~+\"'@`]", text)), len(re.findall("[A-Z]", text))
    part = lambda a, b: a / b if b else 0.0
    failed = words < 50 or 100 * repeats > 50 * words
    return failed, {"symbols": part(symbols, words), "marks": part(marks, words), "upper": part(upper, chars),
                    "dup_lines": part(dups, lines), "repeats": part(repeats, words), "length": part(chars, words)}


def passing(docs):
    rated = {d.doc_id: ratios(d.text or "") for d in docs}
    groups = defaultdict(list)
    for d in docs:
        if not rated[d.doc_id][0]:
            for key in ((d.lang, d.source), (d.lang,), ()):
                groups[key].append(rated[d.doc_id][1])

    def quantile(values, q):
        return sorted(values)[math.ceil(q * len(values)) - 1]

    def fences(key, r):
        least, low, mid, high = (quantile([x[r] for x in groups[key]], q) for q in (0.05, 0.25, 0.5, 0.75))
        return low + SLACK[r] + 8.0 * (low - least), mid + 6.0 * SLACK[r] + 4.0 * (high - low)

    def ok(d):
        failed, values = rated[d.doc_id]
        own, wide = (next((k for k in keys if len(groups[k]) >= 50), ()) for keys in (((d.lang, d.source), (d.lang,)), ((d.lang,),)))
        sources = [k for k in groups if len(k) == 2 and k[0] == d.lang and len(groups[k]) >= 50]

        def limit(r):
            loose = quantile([fences(k, r)[1] for k in sources], 0.5) if len(sources) >= 3 else fences(wide, r)[1]
            return min(fences(own, r)[0], loose)

        return not failed and all(v <= limit(r) for r, v in values.items())

    return [d for d in docs if ok(d)]


def one_of_each(docs):
    keep = {doc_id for doc_id, _, _, kept in brute_components([(d.doc_id, d.text) for d in docs]) if kept}
    return [d for d in docs if d.doc_id in keep]


def clean(docs, items):
    def tokens(text):
        return [t for t in (w.strip(PUNCTUATION) for w in re.findall(r"[^\x20\x09-\x0D]+", text.lower())) if t]

    def grams(t):
        return {tuple(t[i : i + 5]) for i in range(len(t) - 4)}

    items = [tokens(i.text) for i in items]
    out = []
    for d in docs:
        t = tokens(d.text)
        near = [i for i in items if len(grams(i) & grams(t)) >= len(i) // 12]
        if not any(sum(n for _, _, n in brute_tiles(t, i, 5)) >= 0.5 * len(i) for i in near if grams(i) & grams(t)):
            out.append(d)
    return out


def number(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:13], 16)


def mixed(docs):
    weights = [*WEIGHTS.values(), OTHER_WEIGHT]
    streams = defaultdict(list)
    for d in sorted(docs, key=lambda d: (number(str(d.doc_id)), d.doc_id)):
        streams[list(WEIGHTS).index(d.source) if d.source in WEIGHTS else len(WEIGHTS)].append(d.doc_id)
    had, out, slot, period = Counter(), [], 0, sum(weights)
    while len(out) < len(docs):  # earliest deadline first among the released, slot by slot
        released = [i for i, w in enumerate(weights) if had[i] * period // w <= slot]
        i = min(released, key=lambda i: (-(-(had[i] + 1) * period // weights[i]), i))
        out += streams[i][had[i] * BLOCK_ROWS : (had[i] + 1) * BLOCK_ROWS]
        had[i] += 1
        slot += 1
    return out


def sharded(docs, order):
    rows, places = [], defaultdict(list)
    for d in docs:
        score = [1 / -math.log((number(f"{d.doc_id}:{s}") + 0.5) / 2**52) for s in range(corpus_pipeline.SHARDS + 1)]
        shard = max(range(corpus_pipeline.SHARDS), key=lambda s: score[s])
        body = d.text.encode()
        rows.append([d.doc_id, len(body) + 8, zlib.crc32(body), "key", shard, None, corpus_pipeline.SHARDS if score[-1] > score[shard] else shard])
        places[shard].append(order.index(d.doc_id))
    for r in rows:
        r[5] = sorted(places[r[4]]).index(order.index(r[0]))
    return sorted(map(tuple, rows))


def test_stages_equal_plain_python(spark, tmp_path):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    columns, docs = table.columns, sorted(table.collect(), key=lambda d: d.doc_id)
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontamination", "mixing", "sharding"]
    expected = {"quality_rules": passing, "near_dedup": one_of_each, "decontamination": lambda d: clean(d, items)}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, table, SF).write.parquet(str(tmp_path / name))
        table = spark.read.parquet(str(tmp_path / name))
        assert table.columns == columns
        if name in expected:
            docs = expected[name](docs)
            assert sorted(r.doc_id for r in table.collect()) == [d.doc_id for d in docs], name
        else:
            files = sorted((tmp_path / name).glob("part-*.parquet"))
            order = [r.doc_id for f in files for r in spark.read.parquet(str(f)).collect()]
            assert order == mixed(docs)
    last = corpus_pipeline.run(spark, SF)
    assert sorted(tuple(r) for r in last.collect()) == sharded(docs, mixed(docs))
    # Without the mixture the slots are others.
    unmixed = spark.read.parquet(str(tmp_path / "decontamination"))
    slots = {r.doc_id: r.slot for r in corpus_pipeline.sharding(spark, unmixed, SF).collect()}
    assert slots.keys() == {r.doc_id for r in last.collect()} and slots != {r.doc_id: r.slot for r in last.collect()}
    assert listed(spark, f"{shared_dir(spark)}/corpus_pipeline") == []


def test_odd_and_empty_documents(spark, odd, clashing, empty):
    for docs in (odd, clashing, empty):
        columns = docs.columns
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == columns
        assert isinstance(corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect(), list)
