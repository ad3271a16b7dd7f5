import hashlib

from threadtone.functions import sampling


def keys(df):
    return sorted(r.id for r in df.collect())


def test_hash_sample_does_not_depend_on_partitioning(spark):
    df = spark.range(5000)
    one = keys(sampling.hash_sample(df.coalesce(1), "id", 0.2, seed=3))
    many = keys(sampling.hash_sample(df.repartition(7), "id", 0.2, seed=3))
    assert one == many
    assert 850 < len(one) < 1150
    expected = [
        i
        for i in range(5000)
        if int(hashlib.md5(f"3:{i}".encode()).hexdigest()[:8], 16) / 2**32 < 0.2
    ]
    assert one == expected


def test_seed_changes_the_sample(spark):
    df = spark.range(1000)
    assert keys(sampling.hash_sample(df, "id", 0.2, 1)) != keys(
        sampling.hash_sample(df, "id", 0.2, 2)
    )


def test_hash_split_is_a_partition_of_the_rows(spark):
    df = spark.range(3000)
    parts = [keys(p) for p in sampling.hash_split(df, "id", (2, 1, 1), seed=9)]
    assert sorted(sum(parts, [])) == list(range(3000))
    assert 1350 < len(parts[0]) < 1650


def test_rows_without_a_key_are_in_one_part(spark):
    df = spark.createDataFrame([(None,), (None,), (1,)], "id int")
    parts = [p.count() for p in sampling.hash_split(df, "id", (1, 1), seed=1)]
    assert sum(parts) == 3
    marked = sampling.hash_parts(df, "id", (1, 1, 2), seed=1)
    assert marked.columns == ["id", "part"] and marked.where("part is null").count() == 0
    assert sampling.hash_sample(df, "id", 1.0, 1).count() == 3


def test_random_steps_repeat_with_their_seed(spark):
    df = spark.range(2000)
    assert keys(sampling.bernoulli_sample(df, 0.2, 4)) == keys(
        sampling.bernoulli_sample(df, 0.2, 4)
    )
    first, second = sampling.random_split(df, (0.5, 0.5), 4)
    assert sorted(keys(first) + keys(second)) == list(range(2000))


def test_every_class_is_in_every_fold(spark):
    rows = [(f"k{i}", "rare" if i < 9 else "common", i % 7 == 0, None if i % 50 else "x") for i in range(399)]
    rows += [("k3", "rare", False, None), (None, "common", True, "x")]
    df = spark.createDataFrame(rows, "id string, a string, b boolean, c string").repartition(6)
    got = sampling.stratified_folds(df, "id", ["a", "b", "c"], 5, seed=1, stretches=16)
    assert got.columns == ["id", "fold_a", "fold_b", "fold_c"] and got.count() == 400
    both = df.dropDuplicates(["id"]).alias("d").join(got.alias("g"), df["id"].eqNullSafe(got["id"]))
    for c in "abc":
        sizes = {}
        for r in both.select(c, f"fold_{c}").collect():
            sizes.setdefault(r[0], [0] * 5)[r[1]] += 1
        for counts in sizes.values():
            assert max(counts) - min(counts) <= 1 or sum(counts) < 5
    again = sampling.stratified_folds(df.coalesce(1), "id", ["a"], 5, seed=1)
    assert {(r.id, r.fold_a) for r in got.collect()} == {(r.id, r.fold_a) for r in again.collect()}


def test_folds_are_ranks_in_hash_order(spark):
    keys = [str(i) for i in range(200)]
    df = spark.createDataFrame([(k, int(k) % 2) for k in keys], "id string, y int")
    order = lambda k: (int(hashlib.md5(f"4:{k}".encode()).hexdigest()[:8], 16), k)
    got = {r.id: r.fold_y for r in sampling.stratified_folds(df, "id", ["y"], 3, seed=4).collect()}
    for y in (0, 1):
        ranked = sorted((k for k in keys if int(k) % 2 == y), key=order)
        assert [got[k] for k in ranked] == [i % 3 for i in range(100)]
