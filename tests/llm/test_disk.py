"""What the dedup operators leave and exchange on disk."""

import random
import time

import public_tokenizers
from pyspark.sql import functions as F

from driftwood.llm import common, line_dedup, packing, paragraphs
from driftwood.session import ensure_checkpoint_dir, folder_names
from llm_rows import docs_of


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}


def folders(spark, name):
    root = f"{ensure_checkpoint_dir(spark)}/driftwood"
    try:
        return {x for x in folder_names(spark, root) if x.startswith(f"{name}-")}
    except Exception:  # noqa: BLE001 - no table was written yet
        return set()


def copies(spark):
    r = random.Random(3)
    passage = " ".join(f"w{r.randrange(10 ** 6)}" for _ in range(80))
    return docs_of(spark, [(i, " ".join(f"x{r.randrange(10 ** 6)}" for _ in range(40)) + "\n" + passage
                            + f" y{i}\n" + " ".join(f"z{r.randrange(10 ** 6)}" for _ in range(40))) for i in range(6)])


def test_cut_leaves_no_shuffle_files(spark):
    before, conf = shuffle_files(spark), spark.conf.get(common.CLEANUP, None)
    out = common.cut(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    table, path = common.written(out.groupBy("count").agg(F.max("k").alias("k")), "probe")
    end = time.time() + 20
    while shuffle_files(spark) - before and time.time() < end:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert out.count() == 7 and {(r["count"], r["k"]) for r in table.collect()} == {(143, 5), (142, 6)}
    assert spark.conf.get(common.CLEANUP, None) == conf and path.split("/")[-1] in folders(spark, "probe")


def test_key_pairs_of_a_few_combinations_at_a_time(spark):
    r = random.Random(8)
    values = [r.getrandbits(63) for _ in range(40)]
    rows = [(i, v ^ (1 << r.randrange(63)) ^ (1 << r.randrange(63)), 50, i) for i, v in enumerate(values * 3)]
    hashes = spark.createDataFrame(rows, "id long, simhash long, n int, root long")
    whole = {tuple(x) for x in line_dedup.near_hashes(hashes).collect()}
    parts = [{tuple(x) for x in line_dedup.near_hashes(hashes, among=range(i, i + 7)).collect()} for i in (0, 7, 14)]
    assert len(whole) >= 100 and set.union(*parts) == whole and sum(map(len, parts)) == len(whole)


def test_a_line_sends_three_keys_at_a_time(spark, monkeypatch):
    parts, real = [], line_dedup.near_hashes

    def noted(hashes, radius, blocks, agree, among):
        parts.append(among)
        return real(hashes, radius, blocks, agree, among)
    monkeypatch.setattr(line_dedup, "near_hashes", noted)
    assert line_dedup.removed_lines(copies(spark)).count() == 5
    assert [i for p in parts for i in p] == list(range(21)) and max(map(len, parts)) == 3


def test_tables_of_a_run_are_removed(spark):
    before = folders(spark, "units"), folders(spark, "lines")
    docs = copies(spark)
    assert {x["doc_id"] for x in paragraphs.removals(paragraphs.near_paragraphs(docs)).collect()} == {1, 2, 3, 4, 5}
    removed = line_dedup.removed_lines(docs).collect()
    assert {(x["doc_id"], *x["lines"]) for x in removed} == {(i, 1) for i in range(1, 6)}
    assert (folders(spark, "units"), folders(spark, "lines")) == before


def test_words_beside_units_are_made_once(spark):
    """Each side's in one exchange; before, every use of them read the texts again."""
    plan = paragraphs.near_paragraphs(copies(spark))._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan


def test_texts_of_a_few_pairs_at_a_time(spark, monkeypatch):
    """Lines of the same words in another order meet, but are not alike: the
    texts of all such pairs lay on disk at once."""
    r = random.Random(5)
    words = [f"w{r.randrange(10 ** 6)}" for _ in range(30)]
    lines = spark.createDataFrame([(i, " ".join(r.sample(words, 30))) for i in range(12)], "id long, line string")
    sizes, real = [], line_dedup.alike

    def noted(ids, lines, similarity):
        sizes.append(ids.count())
        return real(ids, lines, similarity)
    monkeypatch.setattr(line_dedup, "alike", noted)
    assert line_dedup.near_lines(lines).count() == 0
    assert sum(sizes[1:]) == 66 and max(sizes[1:]) <= 20


def test_new_tables_of_a_run_are_removed(spark):
    names = "occurrences", "distinct", "sets"
    before = [folders(spark, n) for n in names]
    docs = copies(spark)
    assert paragraphs.removals(paragraphs.near_paragraphs(docs)).count() == line_dedup.removed_lines(docs).count() == 5
    assert [folders(spark, n) for n in names] == before


def test_tokenising_gets_small_batches(spark, monkeypatch):
    """Memory of the packing stage: 10,000 texts lay in a batch."""
    seen, real, before = [], packing.cut, spark.conf.get(common.ARROW_ROWS)

    def noted(df):
        seen.append(spark.conf.get(common.ARROW_ROWS))
        return real(df)
    monkeypatch.setattr(packing, "cut", noted)
    pieces = packing.token_pieces(docs_of(spark, [(1, "some words"), (2, None)]),
                                  public_tokenizers.path("byte_bpe_50k.json"))
    assert packing.pack(pieces).count() == 2
    assert seen == ["1000"] and spark.conf.get(common.ARROW_ROWS) == before


def test_texts_of_connected_lines_do_not_move_again(spark, monkeypatch):
    """A line with two words changed in each copy: every two copies meet, and the
    texts of all pairs moved, whatever was connected by then."""
    r = random.Random(7)
    words = [f"w{r.randrange(10 ** 6)}" for _ in range(60)]

    def copy():
        out = list(words)
        for at in r.sample(range(60), 2):
            out[at] = f"v{r.randrange(10 ** 6)}"
        return " ".join(out)
    lines = spark.createDataFrame([(i, copy()) for i in range(40)], "id long, line string")
    real, sizes, real_met, met = line_dedup.alike, [], line_dedup.near_hashes, []

    def noted(ids, lines, similarity):
        sizes.append(ids.count())
        return real(ids, lines, similarity)

    def noted_met(*args):
        out = real_met(*args)
        met.append(out.count())
        return out
    monkeypatch.setattr(line_dedup, "alike", noted)
    monkeypatch.setattr(line_dedup, "near_hashes", noted_met)
    monkeypatch.setattr(line_dedup, "stars", lambda hashes, *rest: hashes.select(
        F.col("id").alias("a"), F.col("id").alias("b")).limit(0))
    root = {x["node"]: x["root"] for x in common.components(line_dedup.near_lines(lines)).collect()}
    assert sum(k == 0 for k in root.values()) > 30 and sum(met) > 100
    assert sum(sizes) < sum(met) / 2


def test_pairs_far_apart_by_the_second_hash_do_not_meet(spark):
    rows = [(1, 5, 50, 1, 0), (2, 5, 50, 2, 2 ** 12 - 1), (3, 5, 50, 3, 2 ** 25 - 1)]
    hashes = spark.createDataFrame(rows, "id long, simhash long, n int, root long, second long")
    assert {tuple(x) for x in line_dedup.near_hashes(hashes).collect()} == {(1, 2)}
    assert line_dedup.near_hashes(hashes.drop("second")).count() == 3
