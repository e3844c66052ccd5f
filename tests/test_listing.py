"""Folders of many objects are listed side by side."""

from tallylake.sources.bronze import list_bronze_objects, listing_roots
from tallylake.sources.snapshots import scan_snapshots

DAYS, HOURS = ("2031-05-04", "2031-05-05"), range(20)


def _objects(root) -> dict[str, int]:
    made = {"near.txt": 4}
    (root / "near.txt").write_text("near")
    for day in DAYS:
        for hour in HOURS:
            for number in range(2):
                key = f"dt={day}/hour={hour:02d}/snapshot_id={number}/body.txt"
                (root / key).parent.mkdir(parents=True)
                (root / key).write_text("x" * (hour + 1))
                made[key] = hour + 1
    return made


def _below(root, roots) -> list[str]:
    return sorted(r.split(f"{root.name}", 1)[-1].strip("/") for r in roots)


def test_levels_of_few_folders_are_opened(spark, tmp_path):
    made = _objects(tmp_path)
    assert _below(tmp_path, listing_roots(spark, str(tmp_path))) == [f"dt={d}/hour={h:02d}" for d in DAYS for h in HOURS] + ["near.txt"]
    found = list_bronze_objects(spark, str(tmp_path)).collect()
    assert {r.key: r.length for r in found} == made and len(found) == len(made)
    metadata = spark.createDataFrame([(k, {"a": k}) for k in made], "object_key STRING, metadata MAP<STRING, STRING>")
    read = scan_snapshots(spark, str(tmp_path), metadata, "body*").collect()
    assert {r.object_key: r.stored_size for r in read} == {k: n for k, n in made.items() if k != "near.txt"}
    assert all(r.metadata == {"a": r.object_key} for r in read)


def test_other_folders_are_listed_as_they_are(spark, tmp_path):
    for name in ("flat", "odd", "hidden"):
        (tmp_path / name).mkdir()
    for n in range(50):
        (tmp_path / "flat" / f"{n}.txt").write_text("x")
    (tmp_path / "odd" / "a{b}").mkdir()
    (tmp_path / "odd" / "c.txt").write_text("x")
    (tmp_path / "hidden" / "_later").mkdir()
    (tmp_path / "hidden" / "_later" / "no.txt").write_text("x")
    (tmp_path / "hidden" / "yes.txt").write_text("x")
    for name, keys in (("flat", 50), ("odd", 1), ("hidden", 1)):
        root = str(tmp_path / name)
        assert listing_roots(spark, root) == [root]
        assert list_bronze_objects(spark, root).count() == keys
    assert listing_roots(spark, str(tmp_path / "absent")) == [str(tmp_path / "absent")]
