import hashlib
import re

from tarmac.llm.exact import advance, append_feed, exact_dedup, keepers
from tests.llm.conftest import by_id


def expected(rows):
    groups = {}
    for doc_id, text in rows:
        normal = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups.setdefault(normal, []).append((-len(text or ""), doc_id is None, doc_id))
    return {normal: (min(members, key=lambda m: m[:2] + (m[2] or 0,)), len(members)) for normal, members in groups.items()}


def check(df, rows):
    groups, found = expected(rows), df.collect()
    assert len(found) == len(rows)
    told = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text_sha256"], r["keep_id"], r["group_size"]) for r in found)
    wanted = []
    for doc_id, text in rows:
        normal = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        (_, _, keep), size = groups[normal]
        wanted.append((doc_id is None, doc_id or 0, hashlib.sha256(normal.encode()).hexdigest(), keep, size))
    assert told == sorted(wanted)
    kept = [r for r in found if r["kept"]]
    assert len(kept) == len(groups) == len({r["text_sha256"] for r in kept})
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def test_odd_rows(odd, no_docs):
    check(exact_dedup(odd), [(r["doc_id"], r["text"]) for r in odd.collect()])
    assert exact_dedup(no_docs).count() == 0


def test_hits_are_checked_by_their_whole_texts(docs_of):
    """With a state key of one digit, most hits are no copies."""
    texts = [f"text {i % 40}" + " " * (i % 3) for i in range(100)]
    check(exact_dedup(docs_of(*texts), key_digits=1), list(enumerate(texts)))


def test_state_goes_on_over_batches_and_calls(spark, docs_of, folder):
    append_feed(docs_of("a", "b", "a"), folder)
    advance(spark, folder)
    append_feed(docs_of("a  ", "c", first=10), folder)
    append_feed(docs_of("b", first=20), folder)
    advance(spark, folder, max_bytes=1)
    state = {(r["keep_id"], r["keep_chars"], r["group_size"]) for r in keepers(spark, folder).collect()}
    assert state == {(10, 3, 3), (1, 1, 2), (11, 1, 1)}


def test_ties_go_to_the_smallest_id(docs_of):
    found = by_id(exact_dedup(docs_of("x y", "x\ty", "xy")))
    assert [found[i][0]["kept"] for i in range(3)] == [True, False, False]


def test_one_row_of_a_group_stays(spark):
    rows = [(1, "a b c"), (1, "ab  c"), (2, "abc"), (1, "a b c"), (None, "x"), (None, "x")]
    check(exact_dedup(spark.createDataFrame(rows, "doc_id long, text string")), rows)
    check(exact_dedup(spark.createDataFrame(rows, "doc_id long, text string"), key_digits=1), rows)


def test_hits_on_earlier_keepers_are_checked_by_their_texts(spark, folder):
    """State keys of no digits: every new document hits the keeper of the first call."""
    first, second = [(1, "first one"), (2, "firstone")], [(3, "first o n e s"), (4, "first on e"), (5, "other"), (6, "ot her")]
    schema = "doc_id long, text string"
    for name, rows in (("a", first), ("b", second)):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}")
    a, b = (spark.read.parquet(f"{folder}/{name}") for name in "ab")
    check(exact_dedup(a, f"{folder}/state", key_digits=0), first)
    found = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup(b, f"{folder}/state", key_digits=0).collect()}
    # the longest text of the second call is the keeper of the state, and differs from others
    assert found == {3: (3, 1, True), 4: (4, 1, True), 5: (6, 2, False), 6: (6, 2, True)}
    again = spark.createDataFrame([(9, "firstones"), (8, "unseen")], schema)
    found = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in exact_dedup(again, f"{folder}/state", key_digits=0).collect()}
    assert found == {9: (3, False), 8: (8, True)}
