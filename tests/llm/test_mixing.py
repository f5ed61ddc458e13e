import hashlib
import math
import re

import pytest

from storelens.llm import mixing

from .conftest import clash, rows_of

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_targets(sizes):
    """Water filling, one round at a time."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    left, open_, target = float(sum(sizes.values())), set(names), {}
    while open_:
        share = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if share * weight[s] >= 3 * sizes[s]}
        if not above:
            return target | {s: share * weight[s] for s in open_}
        for s in above:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_ -= above
    return target


def plain_mix(rows):
    """Taken words by (id, text) position, in the same order of keys."""
    sized = []
    for doc_id, text, _, source, _ in rows:
        text = text or ""
        size = len(WORD.findall(text))
        digest = hashlib.md5(f"{'' if doc_id is None else doc_id}:{hashlib.md5(text.encode()).hexdigest()}".encode()).hexdigest()
        u = (int(digest[:13], 16) + 0.5) / 2 ** 52
        w = 1 / (1 + abs(len(text) / size - 6) / 6) if size else 1.0
        sized.append((source, -math.log(u) / min(1.0, max(0.25, w)), doc_id, size))
    sizes = {}
    for source, _, _, size in sized:
        sizes[source] = sizes.get(source, 0) + size
    targets, out = plain_targets(sizes), []
    for source, total in sizes.items():
        target = targets[source]
        epochs = math.floor(target / total) if total else 0
        rest, ahead = target - epochs * total, 0
        own = sorted((r for r in sized if r[0] == source), key=lambda r: (r[1], r[2] is not None, r[2] or 0, r[3]))
        for _, _, doc_id, size in own:
            out.append((doc_id, size, total, target, (epochs + (2 * ahead + size < 2 * rest)) * size))
            ahead += size
    return out


def close(got, want):
    assert len(got) == len(want)
    order = lambda r: tuple((v is not None, v or 0) for v in r)
    for g, w in zip(sorted(got, key=order), sorted(want, key=order)):
        assert g[:3] == w[:3] and g[3] == pytest.approx(w[3]) and g[4] == w[4]


COLUMNS = ["doc_id", "size", "source_size", "target", "taken"]


@pytest.mark.parametrize("table", ["edge", "documents", "empty"])
def test_agrees_with_plain_version(request, table):
    df = request.getfixturevalue(table)
    rows = [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    close([tuple(r) for r in mixing.mix_documents(df).select(*COLUMNS).collect()], plain_mix(rows))


def test_small_buckets_change_nothing(documents, monkeypatch):
    want = rows_of(mixing.mix_documents(documents), *COLUMNS)
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 7)
    assert rows_of(mixing.mix_documents(documents), *COLUMNS) == want


def test_sources_end_near_their_target(documents):
    taken, target, most = {}, {}, {}
    joined = mixing.mix_documents(documents).join(documents.select("doc_id", "source"), "doc_id").collect()
    for r in joined:
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        target[r["source"]] = r["target"]
        most[r["source"]] = max(most.get(r["source"], 0), r["size"])
        assert r["taken"] <= 3 * r["size"]
    assert all(abs(taken[s] - target[s]) <= most[s] / 2 for s in target)


def test_other_columns_may_clash(edge):
    assert rows_of(mixing.mix_documents(clash(edge)), *COLUMNS) == rows_of(mixing.mix_documents(edge), *COLUMNS)


@pytest.mark.parametrize("table", ["edge", "documents"])
def test_mixed_documents_repeat_what_is_taken(request, table):
    df = request.getfixturevalue(table)
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    copies = {}
    for r in mixing.mix_documents(df).collect():
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + r["copies"]
    got = {}
    for r in out.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    assert got == {k: v for k, v in copies.items() if v}
