from balcao.settings import recommended


def test_partitions_grow_with_the_data(spark):
    small, large = recommended(10, 8), recommended(100 * 2**40, 4_000)
    assert small["spark.sql.shuffle.partitions"] == "8"
    assert large["spark.sql.shuffle.partitions"] == str(100 * 2**40 // (128 * 2**20))
    kept = {key: spark.conf.get(key) for key in small}
    for key, value in (small | {"spark.sql.shuffle.partitions": "8"}).items():
        spark.conf.set(key, value)
    assert spark.range(10).repartition(2).count() == 10
    for key, value in kept.items():
        spark.conf.set(key, value)
