"""Near-duplicates, line runs, repeated strings and decontamination against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from llm_cases import changed, corpus, documents, empty, plain, prose, words

from silverline.llm import components, decontamination, line_runs, near_text, queries, simhash, suffix_dedup


def brute_print(text, how):
    import xxhash

    found = [w.decode() for w in re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()).split()]
    parts = [" ".join(found[k : k + how.words]) for k in range(max(1, len(found) - how.words + 1))] if found else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), seed=how.seed) for p in parts]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes)) if hashes else 0


def roots(n, linked):
    label = list(range(n))
    moved = True
    while moved:
        moved = False
        for a in range(n):
            for b in range(a):
                if label[a] != label[b] and linked(a, b):
                    low = min(label[a], label[b])
                    label[a] = label[b] = low
                    moved = True
    return label


@pytest.mark.parametrize("radius", [0, 2, 9])
def test_simhash(spark, radius):
    how = simhash.SimHash(radius=radius, block=8)
    rows = corpus()
    prints = [brute_print(row[1], how) for row in rows]
    label = roots(len(rows), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= radius)
    ids = defaultdict(list)
    for row, root in zip(rows, label, strict=True):
        ids[root] += [row[0]] if row[0] is not None else []
    want = [(row[0], f"{p:016x}", min(ids[root], default=None)) for row, p, root in zip(rows, prints, label, strict=True)]
    assert plain(simhash.near_duplicates(documents(spark), how).collect()) == plain(want)
    assert simhash.near_duplicates(empty(spark), how).count() == 0


def test_components_of_a_path_a_star_and_a_ring(spark):
    links = [(k, k + 1) for k in range(100, 160)] + [(1, k) for k in range(2, 40)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {got[k] for k in range(100, 161)} == {100} and {got[k] for k in range(1, 40)} == {1} and {got[k] for k in (200, 201, 202)} == {200}


def shingle_set(text, size=5):
    found = (text or "").encode().lower().split()
    return {tuple(found[k : k + size]) for k in range(max(1, len(found) - size + 1))}


def test_near_texts(spark):
    base = prose(50, 200)
    rows = corpus() + [(400 + k, changed(base, 90 + 7 * k), *corpus()[0][2:]) for k in range(12)]
    sets = [shingle_set(row[1]) for row in rows]
    label = roots(len(rows), lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    ids = defaultdict(list)
    for row, root in zip(rows, label, strict=True):
        ids[root].append((row[0] is None, row[0]))
    kept = near_text.keep_one_of_each(documents(spark, rows), near_text.NearTexts(block=16, partners=1))
    assert kept.columns == documents(spark).columns
    assert plain([(r["doc_id"],) for r in kept.collect()]) == plain([(min(group)[1],) for group in ids.values()])
    assert near_text.keep_one_of_each(empty(spark)).count() == 0


def test_near_texts_that_repeat_a_phrase_unequally(spark):
    """Sets agree where repeat counts differ, and the smallest sets that can be near without being equal."""
    rest = corpus()[0][2:]
    rows = []
    for k in range(12):
        for at, (size, phrase, times) in enumerate([(300, 8, 20), (300, 8, 10), (1000, 9, 60)]):
            body, again = prose(3000 + 10 * k + at, size), prose(4000 + 10 * k + at, phrase)
            rows += [(6 * k + 2 * at, f"{body} {again}", *rest), (6 * k + 2 * at + 1, f"{body} {' '.join([again] * times)}", *rest)]
    for k in range(60):
        short = prose(5000 + k, 9)
        rows += [(1000 + 2 * k, short.rsplit(" ", 1)[0], *rest), (1001 + 2 * k, short, *rest)]
    sets = [shingle_set(row[1]) for row in rows]
    label = roots(len(rows), lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    want = defaultdict(list)
    for row, root in zip(rows, label, strict=True):
        want[root].append(row[0])
    kept = near_text.keep_one_of_each(documents(spark, rows))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(min(group) for group in want.values())


def test_family_below_the_limit_is_not_proposed():
    """Fingerprints alone propose most pairs of a family at 0.5 to 0.78; parities leave the links and few more."""
    import numpy as np

    how, base, random = near_text.NearTexts(), prose(70, 200).split(), np.random.default_rng(71)
    texts = []
    for k in range(120):
        at = set(random.choice(200, 4 if k % 10 else 1, replace=False).tolist())
        texts.append(" ".join(f"x{k}y{i}" if i in at else word for i, word in enumerate(base)))
    rows = near_text._prints(how)()([{"key": b"", "doc_id": k, "text": text} for k, text in enumerate(texts)])
    columns = {name: np.array([row.get(name, 0) for row in rows], dtype=np.int64) for name in near_text._STATE}
    columns |= {"id": np.arange(120), "root": np.arange(120), "after": np.full(120, -1)}
    block = tuple(columns[name] for name in near_text._STATE)
    own, other, _ = near_text.propose(block, block, True, 120, how)
    pairs = {(a, b) for a, b in zip(own.tolist(), other.tolist(), strict=True) if a < b}
    sets = [shingle_set(text) for text in texts]
    links = {(a, b) for b in range(120) for a in range(b) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert links and links <= pairs
    assert len(pairs - links) < 0.1 * 120 * 119 / 2


def brute_lines(rows, least):
    """Removed line numbers of each distinct (id, text), by trying every stretch with enough words."""
    order = sorted({(r[0] is not None, r[0] or 0, hashlib.md5(f"{'-' if r[0] is None else r[0]}\x1f{r[1] or ''}".encode()).digest(), r[1] or "") for r in rows if r[1] is not None})
    numbered = []
    for place in order:
        lines = [(no, line, len(words(line))) for no, line in enumerate(place[3].split("\n")) if words(line)]
        numbered.append((place, lines))
    first, gone = {}, defaultdict(set)
    for place, lines in numbered:
        for start in range(len(lines)):
            total = 0
            for end in range(start, len(lines)):
                total += lines[end][2]
                if total >= least:
                    run = tuple(line for _, line, _ in lines[start : end + 1])
                    if first.setdefault(run, (place, start)) != (place, start):
                        gone[place[3], place[1], place[0]] |= {no for no, _, _ in lines[start : end + 1]}
    return gone


@pytest.mark.parametrize("least", [1, 5, 10, 37])
def test_line_runs(spark, least):
    lines = [prose(k, 3) for k in range(6)]
    extra = [(200 + k, "\n".join(lines[k % 3 :] + lines[: k % 4] + [f"own {k}"] + lines[1:4]), *corpus()[0][2:]) for k in range(8)]
    extra += [(300, "\n\n".join(lines), *corpus()[0][2:]), (301, "\n".join([lines[0]] * 7), *corpus()[0][2:])]
    rows = corpus() + extra
    gone = brute_lines(rows, least)
    want = []
    for row in rows:
        text = row[1]
        removed = gone.get((text or "", row[0] or 0, row[0] is not None), set()) if text is not None else set()
        kept = None if text is None else "\n".join(line for no, line in enumerate(text.split("\n")) if no not in removed)
        want.append((row[0], kept, len(removed)))
    got = line_runs.drop_repeated_lines(documents(spark, rows), line_runs.LineRuns(least))
    assert [c for c in got.columns if c not in ("n_lines", "n_runs")] == [c for c in documents(spark).columns if c != "n_removed"] + ["n_removed"]
    assert plain([(r["doc_id"], r["text"], r["n_removed"]) for r in got.collect()]) == plain(want)


def test_line_runs_empty_table_and_plan(spark):
    found = line_runs.drop_repeated_lines(empty(spark))
    assert found.count() == 0
    assert not re.search("Python|Pandas|Arrow", found._jdf.queryExecution().toString().split("== Physical Plan ==")[1])


def test_line_runs_match_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    ours = queries.QUERIES["op5_line_runs"](spark, sf)
    want = con.execute(queries.SQL["op5_line_runs"])
    names = [c[0] for c in want.description]
    assert plain(ours.select(*names).collect()) == plain(want.fetchall())


def brute_repeats(rows, length):
    counts = Counter()
    texts = [(row[0], (row[1] or "").encode()) for row in rows]
    for _, raw in texts:
        for k in range(len(raw) - length + 1):
            counts[raw[k : k + length]] += 1
    out = []
    for doc_id, raw in texts:
        mark = bytearray(len(raw))
        for k in range(len(raw) - length + 1):
            if counts[raw[k : k + length]] > 1:
                mark[k : k + length] = b"\1" * length
        kept = bytes(b for b, m in zip(raw, mark, strict=True) if not m)
        spans = sum(1 for k in range(len(raw)) if mark[k] and not (k and mark[k - 1]))
        out.append((doc_id, len(raw), sum(mark), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize(("length", "choices"), [(400, 320), (60, 30), (60, 1)])
def test_repeated_strings(spark, length, choices):
    shared = prose(77, 200)
    rows = corpus() + [(500 + k, prose(500 + k, 20) + shared[k * 31 : 900 - k * 17] + prose(600 + k, 20), *corpus()[0][2:]) for k in range(15)]
    rows += [(520, "xyz" * 800, *corpus()[0][2:]), (521, shared[:399], *corpus()[0][2:]), (522, shared[:400], *corpus()[0][2:])]
    how = suffix_dedup.Repeats(length, choices)
    assert plain(suffix_dedup.remove_repeats(documents(spark, rows), how).collect()) == plain(brute_repeats(rows, length))


def test_repeated_strings_over_cut_buckets_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_BUCKET", 3000)
    monkeypatch.setattr(suffix_dedup, "_CHUNK", 257)
    shared = prose(78, 300)
    rows = [(k, prose(700 + k, 10) + changed(shared, 30 + k), *corpus()[0][2:]) for k in range(25)]
    how = suffix_dedup.Repeats(100, 70)
    assert plain(suffix_dedup.remove_repeats(documents(spark, rows), how).collect()) == plain(brute_repeats(rows, 100))
    assert suffix_dedup.remove_repeats(empty(spark), how).count() == 0


def test_more_buckets_compare_no_more_windows(spark, monkeypatch):
    """Boundaries between buckets lie between different starts, so none of a common passage's windows crosses them."""
    resolved, stored = [], suffix_dedup._stored

    def keep(frame, name):
        out = stored(frame, name)
        if name == "resolved":
            resolved.append(out)
        return out

    monkeypatch.setattr(suffix_dedup, "_stored", keep)
    shared = prose(79, 60)
    rows = [(k, prose(900 + k, 30) + shared + prose(950 + k, 30), *corpus()[0][2:]) for k in range(40)]
    how, before = suffix_dedup.Repeats(100, 70), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        found = suffix_dedup.remove_repeats(documents(spark, rows), how).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert plain(found) == plain(brute_repeats(rows, 100))
    assert resolved[0].filter("h1 is null").count() > 40
    assert resolved[0].filter("h1 is not null").isEmpty()


def test_places_of_a_common_passage_are_dealt_to_several_tasks(spark):
    shared = prose(80, 60)
    tails = [prose(81, 30), *(prose(82 + k, 30) for k in range(5))]
    rows = [(k, f"{prose(1000 + k, 30)} {shared}{tails[max(0, k - 114)]}", *corpus()[0][2:]) for k in range(120)]
    small = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        found = suffix_dedup.remove_repeats(documents(spark, rows), suffix_dedup.Repeats(100, 70))
        assert plain(found.collect()) == plain(brute_repeats(rows, 100))
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert re.search(r"SortMergeJoin\(skew=true\) \[lead#\d+L?, body", plan)


def test_multikey_order():
    import numpy as np

    tokens = np.random.default_rng(3).integers(0, 4, size=(500, 6)).astype(np.uint64)
    got = tokens[suffix_dedup.multikey_order(tokens)]
    assert (got == tokens[np.lexsort(tokens.T[::-1])]).all()


def brute_matches(docs, items, how):
    def split(text):
        return re.findall(rb"[0-9a-z\x80-\xff]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))

    out = []
    for doc_id, text in docs:
        own = split(text)
        for item_id, item in items:
            wanted = split(item)
            if not own or not wanted:
                continue
            size = min(len(own), len(wanted))
            goal = decontamination.shingle_counts(wanted, how.words)
            scores = [decontamination.similarity(decontamination.shingle_counts(own[k : k + size], how.words), goal) for k in range(len(own) - size + 1)]
            good = [s for s in scores if s >= how.similarity]
            if good:
                out.append((doc_id, item_id, max(scores), scores.index(max(scores)), len(good)))
    return out


def test_decontamination(spark):
    items = [(k, prose(900 + k, 12 + 5 * k)) for k in range(12)] + [(20, None), (21, ""), (22, "two words"), (None, prose(950, 30)), (23, "a b " * 12)]
    docs = [(row[0], row[1]) for row in corpus()]
    docs += [(600 + k, prose(40 + k, 25) + " " + changed(items[k][1], 40).upper() + ", " + prose(41 + k, 25)) for k in range(12)]
    docs += [(620, items[3][1]), (621, items[11][1][:-9]), (622, "x two  WORDS, y"), (623, prose(950, 30)), (623, prose(950, 30)), (624, "b a " * 30)]
    docs += [(625, "two words"), (626, "two")]
    how = decontamination.Contamination(radius=40)
    rows = [(i, t, *corpus()[0][2:]) for i, t in docs]
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = [(r[0], r[1], r[2], r[3], r[4]) for r in decontamination.contaminated(documents(spark, rows), benchmark, how).collect()]
    want = brute_matches(docs, items, how)
    assert plain([(a, b, round(s, 9), w, n) for a, b, s, w, n in got]) == plain([(a, b, round(s, 9), w, n) for a, b, s, w, n in want])
    # Several blocks give the same, and the default radius loses none of these.
    small = decontamination.Contamination(block_bytes=400)
    assert plain([(r[0], r[1]) for r in decontamination.contaminated(documents(spark, rows), benchmark, small).collect()]) == plain([(w[0], w[1]) for w in want])
    left = decontamination.drop_contaminated(documents(spark, rows), benchmark, small)
    assert left.columns == documents(spark).columns
    bad = {(w[0]) for w in want}
    assert plain([(r["doc_id"],) for r in left.collect()]) == plain([(i,) for i, _ in docs if i not in bad])
    assert decontamination.contaminated(empty(spark), benchmark).count() == 0
    assert decontamination.contaminated(documents(spark), benchmark.limit(0)).count() == 0


def test_windows_at_the_limit_lie_within_the_radius():
    """Bits of fingerprints at similarity 0.8 differ with a probability of 0.19 at most."""
    import math

    radius = decontamination.Contamination().radius
    assert sum(math.comb(64, k) * 0.19**k * 0.81 ** (64 - k) for k in range(radius + 1, 65)) < 1e-5


def test_block_index_returns_all_within_radius():
    import random

    rng = random.Random(5)
    prints = [rng.getrandbits(64) for _ in range(200)]
    index = decontamination.BlockIndex(prints, 20)
    for _ in range(100):
        bits = rng.choice(prints)
        for place in rng.sample(range(64), 18):
            bits ^= 1 << place
        assert index.within(bits) == {k for k, p in enumerate(prints) if (p ^ bits).bit_count() <= 20}


def test_windows_across_buckets():
    """Buckets parted where sorted bytes differ, or anywhere if they say so, find what one bucket finds."""
    import random

    rng = random.Random(11)
    how = suffix_dedup.Repeats(20, 12)
    for _ in range(60):
        classes = {}
        for number in range(rng.randrange(2, 40)):
            context = bytes(rng.choice(b"ab") if rng.random() < 0.08 else 97 + k % 2 for k in range(rng.randrange(20, 32)))
            off = rng.randrange(len(context) - 20, 12)
            classes[number] = (number, number, rng.choice([1, 1, 1, 2]), off, context)
        rows = sorted(classes.values(), key=lambda c: c[4][c[3] : c[3] + how.sorted_bytes])

        def repeated(buckets):
            found, border = set(), defaultdict(list)
            for bucket, begun, goes_on in buckets:
                table = suffix_dedup.resolve_bucket(*map(list, zip(*bucket, strict=True)), how, begun, goes_on)
                for r in table.to_pylist():
                    if r["h1"] is None:
                        found |= {(r["lead"], k) for k in range(r["s"], r["e"] + 1)}
                    else:
                        border[r["h1"], r["h2"]].append((r["lead"], r["s"], r["open"]))
            return found | {(lead, s) for same in border.values() if len(same) > 1 for lead, s, is_open in same if is_open}

        # Only windows that name the same anchor are compared: as in the operator, by place behind the anchor.
        windows = Counter()
        for number, _, n, off, context in rows:
            for k in range(min(off, len(context) - 20) + 1):
                windows[off - k, context[k : k + 20]] += n
        if len({context for *_, context in rows}) < len(rows) or any(off > 11 for _, _, _, off, _ in rows):
            continue
        cuts = sorted({0, len(rows), *(rng.randrange(1, len(rows)) for _ in range(3))})
        buckets = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            head = lambda k: rows[k][4][rows[k][3] : rows[k][3] + how.sorted_bytes]
            buckets.append((rows[a:b], a > 0 and head(a - 1) == head(a), b < len(rows) and head(b - 1) == head(b)))
        whole = repeated([(rows, False, False)])
        parted = repeated(buckets)
        want = {(number, k) for number, _, _, off, context in rows for k in range(len(context) - 19) if k <= off and windows[off - k, context[k : k + 20]] > 1}
        assert want <= whole and want <= parted
