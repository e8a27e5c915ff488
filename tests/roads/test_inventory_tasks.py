"""The inventory is dealt to tasks by its number of segments, not by the size of the file."""

from kerbline import bindings


def test_keys_are_dealt(spark, sf, monkeypatch):
    whole = sorted(r.seg_id for r in bindings.inventory(spark, sf).select("seg_id").collect())
    monkeypatch.setattr(bindings, "SEGMENTS", 50)
    dealt = bindings.inventory(spark, sf)
    assert dealt.rdd.getNumPartitions() == len(whole) // 50 + 1 > 1
    assert sorted(r.seg_id for r in dealt.select("seg_id").collect()) == whole
