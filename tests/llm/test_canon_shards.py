from callweave.llm.canon import map_values

SCHEMA = "record_id long, journal string, journals array<string>"
REF = "id long, name string, publisher string, aliases array<string>"
#: Pairs of entries that one value may mean, by a literal reading and by an abbreviation or a stripped one.
REFERENCE = [(1, "J. Sleep", None, None), (3, "Touch (Letters)", "Acme", None), (4, "Touch", None, None), (5, "Gaze Reports", "Field House", None)] + [(i, "Journal Sleep", None, None) for i in (2,)] + [(10 + i, f"Filler number {'abcdefghijklmnopqrst'[i] * 3}", None, None) for i in range(20)]
VALUES = ["j. sleep", "J Sleep", "touch (letters)", "Field House: Gaze Reports", "Acme: Touch", "Journl Sleep", "gaze reports"]


def test_shards_give_what_one_tree_gives(spark):
    df, ref = spark.createDataFrame([(i, v, None) for i, v in enumerate(VALUES)], SCHEMA), spark.createDataFrame(REFERENCE, REF)
    whole = {tuple(r) for r in map_values(df, "record_id", "journal", "journals", ref).collect()}
    assert whole >= {(0, 0, 1), (1, 0, 1), (2, 0, 3), (3, 0, 5), (4, 0, 4)}
    for n in (1, 3, 6):
        assert {tuple(r) for r in map_values(df, "record_id", "journal", "journals", ref, broadcast_entries=2, shard_entries=n).collect()} == whole
