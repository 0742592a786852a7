import dataclasses
import datetime
import json
import math

import duckdb
import pytest
import yaml
from pyspark.sql import functions as F

from loomery import config, schema
from loomery.functions import captions, detect, prng, scalars
from loomery.operators import binding, boxes, canon, doctor, eligibility, evalpack, evalrun, lineage, production, records, rows, snapshot, split
from loomery.plans import queries, testbed as t
from loomery.sources import packages, readers, writers
from loomery.streaming import logs


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


# ---- scalars, generator, detection ------------------------------------------------------------


def test_generator_vectors(spark):
    assert list(prng.draws(42, 1, 4)) == [0.6011037519201636, 0.44829055899754167, 0.8524657934904099, 0.6697340414393693]
    assert list(prng.draws(0, 1, 2)) == [0.26642920868471265, 0.0003297457005828619]
    assert prng.shuffled([f"f{i:02}" for i in range(10)], 42, 1) == "f00 f07 f03 f05 f02 f01 f08 f09 f04 f06".split()
    for seed in (0, 7, 12345, 2**32 - 1):
        column = [r["u"] for r in spark.range(1, 400).select("id", prng.draw(seed, F.col("id")).alias("u")).orderBy("id").collect()]
        assert column == list(prng.draws(seed, 1, 399))


def test_scalars(spark):
    assert one(spark, scalars.rounded(F.lit(-2.5))) == -2
    assert one(spark, scalars.strip_version(F.lit("a_v1_s22"))) == "a_v1" and one(spark, scalars.strip_version(F.lit("a_v1\n"))) == "a_v1\n"
    assert scalars.to_fixed(1.005, 2) == "1.00" and scalars.to_fixed(0.0625, 3) == "0.063"
    names = F.array(*map(F.lit, ("snapshot", "split", "select")))
    assert one(spark, scalars.closest(F.lit("SPLTI"), names)) == "split" and one(spark, scalars.closest(F.lit("zzzzzz"), names)) is None
    assert one(spark, scalars.closest(F.lit("ab"), F.array(F.lit("cd"), F.lit("ad")))) == "ad" and one(spark, scalars.closest(F.lit(""), names)) is None
    for path, ok in (("a/b.png", True), ("../a", False), ("a/../b", False), ("/a", False), ("C:\\a", False), ("a\\..\\b", False), ("", False), ("a..b", True)):
        assert one(spark, scalars.safe_path(F.lit(path))) is ok
    assert config.java_pattern(r"^a$|b\$[$]") == r"^a\z|b\$[$]"


def test_detection(spark):
    lanes = config.Lanes((config.Lane("ship", ("^ship_",)), config.Lane("none"), config.Lane("prop", ("^prop_", "UPPER"))), "costume")
    for record_id, lane in (("SHIP_a", "ship"), ("prop_x", "prop"), ("x_UPPER", "costume"), ("other", "costume")):
        assert one(spark, detect.lane_of(F.lit(record_id), lanes)) == lane
    terms = dataclasses.replace(t.TERMS, groups=(config.Group("red", ("^r_",), ("crimson",)), config.Group("blue", ("^b_",), ("navy",))), cross_group=(("^x_", "detect_from_id_suffix"), ("^y_", "none")), edge_defaults=(("^e_", "blue"),), null_patterns=("^n_",), id_fallbacks=(("_z$", "red"),))
    for record_id, prompt, group in (("r_1", "navy", "red"), ("R_1", "Navy", "blue"), ("x_1_blue", "crimson", "blue"), ("x_1", "crimson", None), ("y_blue", "navy", None), ("e_1", "crimson", "blue"), ("n_1_z", "", None), ("q_z", "", "red"), ("q", None, None)):
        assert one(spark, detect.group_of(F.lit(record_id), F.lit(prompt).cast("string"), terms)) == group


# ---- eligibility and binding -------------------------------------------------------------------


def record(record_id, status="approved", passes=5, of=5, **more):
    checks = [{"rule_id": f"R{i}", "verdict": "pass" if i < passes else "fail"} for i in range(of)]
    base = {"id": record_id, "asset_path": f"img/{record_id}.png", "provenance": {"prompt": "a prompt"}, "judgment": {"status": status, "failure_modes": []} if status else None}
    return base | {"canon": {"assertion_count": of, "pass_count": passes, "assertions": checks} if of else None} | more


@pytest.fixture(scope="module")
def project_dir(tmp_path_factory):
    root = tmp_path_factory.mktemp("project")
    lanes = {"default_lane": "boats", "lanes": [{"id": "coats", "id_patterns": ["^coat_", "_coat$"]}, {"id": "boats", "id_patterns": ["^boat_"]}]}
    rule = {"id": "SIL-1", "category": "outline", "dims": ["clarity"]}
    rubric = {"dimensions": ["clarity"], "thresholds": {"approved": {"pass": 0.8, "partial": 0.4}}}
    for name, value in (("project", {"meta": {"name": "harbour"}}), ("constitution", {"version": "3.1.0", "rules": [rule]}), ("lanes", lanes), ("rubric", rubric), ("terminology", {"groups": []})):
        (root / f"{name}.json").write_text(json.dumps(value))
    return root


def records_of(spark, rows_):
    return spark.read.schema(schema.RECORD).json(spark.sparkContext.parallelize([json.dumps(r) for r in rows_], 2))


def test_configuration(project_dir, tmp_path):
    project = config.load_project(project_dir)
    assert project.lanes.default == "boats" and project.rubric.thresholds["approved"] == (0.8, 0.4) and project.rubric.thresholds["rejected"] == (0.6, 0.4) and project.rules[0].id == "SIL-1"
    before = config.fingerprint(project_dir)
    assert before == config.fingerprint(project_dir) and len(before) == 64
    (tmp_path / "selection-profiles").mkdir()
    (tmp_path / "selection-profiles/p.json").write_text('{"require_status": ["borderline"], "strange": 1}')
    assert config.load_profile(tmp_path, "selection-profiles", "p", config.SelectionProfile()).require_status == ("borderline",)
    assert config.load_profile(tmp_path, "selection-profiles", "nope", config.SelectionProfile()) == config.SelectionProfile()
    with pytest.raises(config.InputError):
        config.load_project(tmp_path)


def test_eligibility_reasons(spark, project_dir):
    project = config.load_project(project_dir)
    profile = config.SelectionProfile(exclude_lanes=("coats",), rights_filter="cleared", exclude_tags=("wip",), minimum_pass_ratio=0.5)
    rows_ = [
        record("boat_2_v1", rights_status="cleared"), record("boat_4_v1", status=None, of=0, rights_status="", training_rights_status="cleared"), record("boat_6_v1", status="rejected", passes=2, rights_status="no"),
        record("coat_1_v1", rights_status="cleared", dataset_tags=["a", "wip"]), record("boat_8_v1", rights_status=None),
    ]
    out = {r["id"]: [x["code"] for x in r["reasons"]] for r in eligibility.evaluate(records_of(spark, rows_), project, profile).collect()}
    assert out == {"boat_2_v1": [], "boat_4_v1": ["no_judgment", "not_canon_bound"], "boat_6_v1": ["wrong_status", "low_pass_ratio", "rights_filter"], "coat_1_v1": ["excluded_lane", "excluded_tags"], "boat_8_v1": ["rights_filter"]}
    messages = eligibility.evaluate(records_of(spark, rows_[2:3]), project, profile).first()["reasons"]
    assert [m["message"] for m in messages] == ['status "rejected" not in [approved]', "pass ratio 40% below minimum 50%", 'rights "no" does not match required "cleared"']
    nothing = config.SelectionProfile(require_judgment=False, require_status=(), require_canon_bound=False, minimum_pass_ratio=None)
    assert eligibility.evaluate(records_of(spark, rows_), project, nothing).where("eligible").count() == 5


def test_binding_skips_bound_records(spark):
    rows_ = [record("doc_0_v1", of=0), record("doc_5_v1"), record("doc_1_v1", status=None, of=0)]
    for r in rows_[:2]:
        r["judgment"] |= {"criteria_scores": {"clarity": 0.9, "balance": 0.55, "detail": 0.2}}
    frame = records_of(spark, rows_)
    assert {r["id"] for r in binding.assertions(frame, t.PROJECT, force=False).collect()} == {"doc_0_v1"}
    bound = {r["id"]: r["canon"] for r in binding.bind(frame, t.PROJECT).collect()}
    assert [(a["rule_id"], a["verdict"]) for a in bound["doc_0_v1"]["assertions"]] == [("PAL-001", "partial"), ("SHP-001", "partial")]
    assert bound["doc_0_v1"]["partial_count"] == 2 and bound["doc_5_v1"]["assertion_count"] == 5 and bound["doc_1_v1"] is None


# ---- lineage, split -----------------------------------------------------------------------------


def test_roots(spark):
    edges = [("t", "a"), ("a", "b"), ("b", "c"), ("c", "a"), ("d", "zz"), ("e", None), ("f", ""), ("s", "s")] + [(f"n{i}", f"n{i - 1}") for i in range(1, 150)]
    got = {r["id"]: r["root"] for r in lineage.roots(spark.createDataFrame(edges, "id string, parent string")).collect()}
    assert {k: got[k] for k in "tabcds"} == {"t": "a", "a": "a", "b": "b", "c": "c", "d": "zz", "s": "s"} and got["n149"] == "n0" and "e" not in got and "f" not in got


def test_families(spark):
    rows_ = [record("x_v1", identity={"subject_name": "ann"}), record("y_v2", lineage={"derived_from_record_id": "x_v1"}), record("z_s3"), record("w", lineage={"derived_from_record_id": "gone_v9"})]
    assert {r["id"]: r["family"] for r in lineage.families(records_of(spark, rows_)).collect()} == {"x_v1": "ann", "y_v2": "ann", "z_s3": "z", "w": "gone"}


@pytest.mark.parametrize("n,ratios,expected", [(0, (0.8, 0.1, 0.1), (0, 0, 0)), (2, (0.8, 0.1, 0.1), (2, 0, 0)), (3, (0.8, 0.1, 0.1), (1, 1, 1)), (6, (0.95, 0.04, 0.01), (4, 1, 1)), (20, (0.7, 0.15, 0.15), (14, 3, 3))])
def test_allocation(n, ratios, expected):
    got = split.allocate(n, config.SplitProfile("p", *ratios))
    assert sum(got) == n and got == expected


def test_roots_of_circles_and_long_ways_to_them(spark):
    """A circle of 40 nodes, a chain of 60 into it, an open chain, a node that is its own parent: against a plain walk."""
    parent = {f"c{i}": f"c{(i + 1) % 40}" for i in range(40)} | {f"t{i}": f"t{i + 1}" if i < 59 else "c7" for i in range(60)} | {f"o{i}": f"o{i + 1}" for i in range(30)} | {"self": "self", "s1": "self", "c7b": "t3"}

    def walk(node):
        seen = [node]
        while parent.get(seen[-1]) is not None:
            if parent[seen[-1]] in seen:
                return parent[seen[-1]]
            seen.append(parent[seen[-1]])
        return seen[-1]

    found = {r["id"]: r["root"] for r in lineage.roots(spark.createDataFrame([*parent.items(), ("none", None)], "id string, parent string")).collect()}
    assert found == {n: walk(n) for n in parent}


def families_frame(spark, n, versions):
    rows_ = [(f"item_{i:03}_v{v}", f"item_{i:03}", "coats" if i % 2 else "boats") for i in range(n) for v in range(1, versions + 1)]
    return spark.createDataFrame(rows_, "id string, family string, lane string")


@pytest.mark.parametrize("seed", [0, 1, 17, 99, 12345])
def test_split_never_leaks(spark, seed):
    members = families_frame(spark, 20, 3)
    out = split.create(members, config.SplitProfile("p", 0.7, 0.15, 0.15, seed))
    assert out.count() == 60 and split.leakage(out).count() == 0
    again = split.create(members.repartition(7), config.SplitProfile("p", 0.7, 0.15, 0.15, seed))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, again.collect()))


def test_split_depends_on_seed_and_keeps_every_part(spark):
    members = families_frame(spark, 20, 1)
    a, b = ({r["record_id"]: r["part"] for r in split.create(members, config.SplitProfile(seed=s)).collect()} for s in (0, 42))
    assert a != b and set(a.values()) == {"train", "val", "test"}
    small = split.create(families_frame(spark, 2, 4), config.SplitProfile())
    assert {r["part"] for r in small.collect()} == {"train"}


# ---- evaluation -----------------------------------------------------------------------------------


def test_eval_scores(spark):
    tasks = spark.createDataFrame([(f"r{i}", "l") for i in range(10)], "record_id string, lane string")
    outputs = evalrun.last_outputs(spark.createDataFrame([(f"r{i}", i, i < 7) for i in range(9)] + [("r0", 50, False), ("r8", 60, True)], "record_id string, pos int, accept boolean"), F.col("pos"))
    card = evalrun.lane_coverage(tasks, outputs).first()
    assert (card["total"], card["good"], card["score"], card["passed"], card["samples"]) == (10, 7, 0.7, True, ["r0", "r7", "r9"])
    drift = evalrun.forbidden_drift(tasks, outputs).first()
    assert drift["good"] == 3 and not drift["passed"] and len(drift["samples"]) == 5
    none = tasks.limit(0)
    empty = [f(none, outputs).first() for f in (evalrun.lane_coverage, evalrun.forbidden_drift, evalrun.anchor_gold)]
    assert [(c["score"], c["passed"]) for c in empty] == [(0.0, False), (1.0, True), (0.0, False)]
    subjects = spark.createDataFrame([("a", ["r1", "r2"]), ("b", ["r1", "r7"]), ("c", [])], "subject_name string, record_ids array<string>")
    assert (evalrun.subject_continuity(subjects, outputs).first()["good"]) == 1
    cards = evalrun.lane_coverage(tasks, outputs).unionByName(evalrun.forbidden_drift(tasks, outputs))
    assert tuple(evalrun.overall(cards).first()) == (False, 0.5, 2) and tuple(evalrun.overall(cards.limit(0)).first()) == (True, 0.0, 0)


def test_eval_ties_go_by_file_name(spark):
    located = records_of(spark, [record("a-b"), record("a"), record("a_b")]).withColumns({"lane": F.lit("l"), "grp": F.lit(None).cast("string")})
    assert [r["record_id"] for r in evalpack.lane_coverage(located, 2).collect()] == ["a-b", "a"]


# ---- rows, captions, canon ---------------------------------------------------------------------------


def test_rows(spark):
    located = records_of(spark, [record("one_v1", canon={"faction": "red", "assertion_count": 3, "pass_count": 1, "forbidden_inputs": ["x"]}), record("two", asset_path=None), record("three", of=0, provenance=None)]).withColumns({"lane": F.lit("hull"), "grp": F.lit("red")})
    made = {r["entity_id"]: r for r in rows.from_records(located, t.TRAINING, F.lit("train")).collect()}
    assert set(made) == {"one_v1", "three"} and made["one_v1"]["pass_ratio"] == 0.333 and made["three"]["pass_ratio"] is None
    assert made["one_v1"]["caption"] == "house_style_lora, red, hull, a prompt" and made["three"]["caption"] == "house_style_lora, red, hull, three"
    line = rows.serialised(rows.from_records(located, t.TRAINING, F.lit("train")).withColumn("aaa", F.lit(1))).first()["value"]
    assert list(json.loads(line)) == [*rows.KEYS, "aaa"] and json.loads(line)["entry_hash"] is None
    bad = spark.createDataFrame([("other",)], "schema_version string")
    with pytest.raises(Exception, match="schema_version"):
        rows.checked(bad).collect()
    for strategy, text in (("structured-metadata", "house_style_lora, red faction, hull"), ("flux-natural-language", "house_style_lora style, a red faction hull"), ("strange", "red, hull, a prompt")):
        profile = config.TrainingProfile("house-style-lora", caption_strategy=strategy)
        assert located.where("id = 'one_v1'").select(captions.caption(F.col, F.col("lane"), F.col("grp"), profile)).first()[0] == text


def test_watch_hash():
    entry = {"a": {"b": 1.0}, "body": "x", "list": [1, None, "é"]}
    base = canon.watch_hash(entry, ["a.b", "list"], "v1")
    assert base == canon.watch_hash({"list": [1, None, "é"], "a": {"b": 1}}, ["list", "a.b"], "v1")
    assert base != canon.watch_hash(entry, ["a.b"], "v1") and base != canon.watch_hash(entry, ["a.b", "list"], "v2")
    assert canon.canonical({"b": math.nan, "a": [1.5, 2.0, True, None, 'q"']}) == '{"a":[1.5,2,true,null,"q\\""],"b":null}'


def test_drift_and_gate(spark):
    entries = spark.createDataFrame([("a", "relic", '{"freeze":{"status":"frozen"},"x":1,"y":2}', "v1"), ("b", "relic", '{"freeze":{"status":"odd"}}', "v1"), ("c", "deity", '{"freeze":{"status":"soft-advisory","watch_fields":["y"]},"y":3}', "v1")], "id string, schema_kind string, entry string, schema_version string")
    now = canon.with_watch_hash(entries, {"relic": ["x"]})
    stamped = now.select("id", F.col("watch_hash").alias("witness_hash"))
    assert {r["id"]: r["drift"] for r in canon.drift(now, stamped.where("id <> 'c'")).collect()} == {"a": "clean", "c": "no-witness"}
    edited = canon.with_watch_hash(entries.withColumn("entry", F.replace("entry", F.lit('"y":2'), F.lit('"y":9'))), {"relic": ["x"]})
    assert {r["drift"] for r in canon.drift(edited, stamped).collect()} == {"clean"}
    edited = canon.with_watch_hash(entries.withColumn("entry", F.replace("entry", F.lit('"x":1'), F.lit('"x":9'))), {"relic": ["x"]})
    assert {r["id"]: r["drift"] for r in canon.drift(edited, stamped).collect()} == {"a": "drifted", "c": "clean"}
    assert {r["id"]: r["decision"] for r in canon.gate(now, True, "why").collect()} == {"a": "refused", "b": "allowed", "c": "bypassed"}
    assert {r["decision"] for r in canon.gate(now.where("id = 'c'"), True, "").collect()} == {"refused"}


# ---- sources, writers, streams -----------------------------------------------------------------------


def test_record_scan(spark, tmp_path):
    for name, text in (("a.json", json.dumps(record("a"), indent=1)), ("bad.json", "{nope"), ("note.txt", "x")):
        (tmp_path / name).write_text(text)
    collected = readers.records(spark, str(tmp_path))
    assert [(r["record_id"], r["file"]) for r in readers.unreadable(collected.cache()).collect()] == [("bad", "bad.json")]
    assert [r["id"] for r in readers.records(spark, str(tmp_path), "skip").collect()] == ["a"]
    with pytest.raises(Exception):
        readers.records(spark, str(tmp_path), "fail").collect()
    assert {r["id"]: r["asset_path"] for r in readers.lookup(spark.createDataFrame([("a",), ("z",)], "id string"), readers.records(spark, str(tmp_path), "skip")).collect()} == {"a": "img/a.png", "z": None}


def test_front_matter(spark, tmp_path):
    (tmp_path / "one.md").write_text("\ufeff---\r\nid: hero\r\nvisual:\r\n  build: slim\r\n---\r\n\r\nBody\r\n")
    (tmp_path / "two.md").write_text("---\nname: x\n---\nText")
    (tmp_path / "bad.md").write_text("no fence")
    got = {r["file"]: r for r in readers.entries(spark, str(tmp_path), "character").collect()}
    assert got["one.md"]["id"] == "hero" and json.loads(got["one.md"]["entry"])["visual"]["build"] == "slim" and got["one.md"]["body"] == "Body\n"
    assert got["two.md"]["id"] == "two" and got["bad.md"]["error"]
    for text in ("---", "---\na: 1\n", "---\n- 1\n---\n", "---\na: [\n---\n"):
        assert readers.split_front_matter(text)[2]


def test_packages(spark, tmp_path):
    located = records_of(spark, [record(f"doc_{i}_v1") for i in range(6)]).withColumns({"lane": F.lit("hull"), "grp": F.lit(None).cast("string")})
    made = rows.from_records(located, t.TRAINING, F.when(F.col("id") == "doc_0_v1", "test").otherwise("train"))
    target = str(tmp_path / "data")
    for _ in range(2):
        writers.swapped(spark, target, lambda path: writers.dataset(path, made))
    assert spark.read.text(target).count() == 6
    lines = writers.checksums(spark, target).collect()
    assert lines and all(r["line"].startswith(f"SHA256 ({r['name']}) = ") for r in lines)
    listing = located.select(F.col("asset_path").alias("path")).where("path <> 'img/doc_5_v1.png'")
    placed, audit = writers.adapted(made, t.TRAINING, listing)
    assert audit.columns == ["partition", "file", "record_id", "caption", "lane", "group", "pass_ratio"] and audit.count() == 5
    files = {r["name"]: bytes(r["content"]).decode() for r in writers.sidecars(placed).collect()}
    captions_of = {r["entity_id"]: r["caption"] for r in made.collect()}
    assert files["dataset/test/doc_0_v1.txt"] == captions_of["doc_0_v1"] + "\n"
    for family in (None, "sdxl"):
        with pytest.raises(config.InputError, match="target_family"):
            writers.adapted(made, dataclasses.replace(t.TRAINING, adapter="ai-toolkit", target_family=family), listing)


def test_swap_leaves_the_old_folder_where_writing_fails(spark, tmp_path):
    target = tmp_path / "data"
    target.mkdir()
    (target / "old").write_text("old")

    def fail(path):
        raise RuntimeError("no space")

    with pytest.raises(RuntimeError):
        writers.swapped(spark, str(target), fail)
    assert (target / "old").read_text() == "old"
    writers.swapped(spark, str(target), lambda path: spark.range(1).write.json(path))
    assert not (target / "old").exists() and [p.name for p in tmp_path.iterdir()] == ["data"]


def test_export_package(spark, tmp_path):
    located = records_of(spark, [record(f"doc_{i}_v1") for i in range(4)]).withColumns({"lane": F.lit("hull"), "grp": F.lit(None).cast("string")})
    included = located.select(F.col("id").alias("record_id"))
    assigned = included.select("record_id", F.lit("fam").alias("family"), F.lit("hull").alias("lane"), F.when(F.col("record_id") == "doc_0_v1", "val").otherwise("train").alias("part"))
    images = located.where("id <> 'doc_3_v1'").select(F.col("asset_path").alias("path"), F.encode("id", "utf-8").alias("content"))
    ids, profile = {"export_id": "export-1", "snapshot_id": "s", "split_id": "p"}, config.ExportProfile(image_strategy="copy")
    build = lambda path, **k: packages.export_package(spark, str(path), included, located, assigned, profile, ids, "f" * 64, k.get("now", "f" * 64), images, "# card\n")
    made = build(tmp_path / "one")
    assert made["counts"] == {"records": 4, "images": 3, "images_expected": 4, "images_actual": 3, "images_failed": 1}
    assert made["images_failed"] == [{"record_id": "doc_3_v1", "reason": "source_missing"}] and made["warnings"]
    assert (tmp_path / "one/images/doc_0_v1.png").read_bytes() == b"doc_0_v1" and readers.manifest(spark, str(tmp_path / "one/manifest.json"))["export_id"] == "export-1"
    lines = [r[0] for r in spark.read.text(str(tmp_path / "one/checksums")).collect()]
    assert any(line.startswith("SHA256 (images/doc_1_v1.png) = ") for line in lines) and any("(manifest.json)" in line for line in lines)
    assert spark.read.json(str(tmp_path / "one/splits")).groupBy("part").count().orderBy("part").collect()[0][1] == 3
    with pytest.raises(config.InputError, match="there already"):
        build(tmp_path / "one")
    with pytest.raises(config.InputError) as wrong:
        build(tmp_path / "two", now="0" * 64)
    assert wrong.value.code == "FINGERPRINT_DRIFT" and not (tmp_path / "two").exists()
    for bad in ("/etc/x.png", "../x.png"):
        assert packages.unsafe_assets(located.withColumn("asset_path", F.lit(bad))).count() == 4


def test_training_package(spark, tmp_path):
    located = records_of(spark, [record(f"doc_{i}_v1") for i in range(4)]).withColumns({"lane": F.lit("hull"), "grp": F.lit(None).cast("string")})
    profile = dataclasses.replace(t.TRAINING, adapter="ai-toolkit", target_family="flux", training_hyperparameters={"rank": 16, "steps": 2000}, eligible_lanes=())
    made = rows.from_records(located, profile, F.when(F.col("id") == "doc_0_v1", "val").otherwise("train"))
    images = located.select(F.col("asset_path").alias("path"), F.encode("id", "utf-8").alias("content"))
    out = packages.training_package(spark, str(tmp_path / "pkg"), made, profile, images, {"training_package_id": "p1", "source_export_id": "e1"}, "f")
    assert out["counts"] == {"total_records": 4, "train": 3, "val": 1, "test": 0, "images": 4}
    job = yaml.safe_load((tmp_path / "pkg/ai-toolkit-config.yaml").read_text())["config"]
    assert job["name"] == f"{profile.profile_id}-e1" and job["process"][0]["network"] == {"type": "lora", "linear": 16, "linear_alpha": 16} and job["process"][0]["train"]["steps"] == 2000
    assert (tmp_path / "pkg/dataset/val/doc_0_v1.txt").read_text().endswith("\n") and (tmp_path / "pkg/dataset/train/doc_1_v1.png").exists()
    assert {r["record_id"] for r in spark.read.json(str(tmp_path / "pkg/metadata")).where("partition = 'train'").collect()} == {"doc_1_v1", "doc_2_v1", "doc_3_v1"}


def test_manifest_versions_only_warn(spark, tmp_path, caplog):
    (tmp_path / "m.json").write_text('{"schema_version": "1.0.0", "x": 1}')
    assert readers.manifest(spark, str(tmp_path / "m.json"))["x"] == 1 and "expected" in caplog.text
    (tmp_path / "bad.json").write_text("[1]")
    with pytest.raises(config.InputError):
        readers.manifest(spark, str(tmp_path / "bad.json"))


def test_build_configuration(tmp_path):
    good = {"project_id": "p", "canon_root": "canon", "schema_dir": "/abs", "entity_dirs": {"hero.schema.json": "heroes"}, "schema_to_lane": {"hero.schema.json": {"source": "field", "field": "visual.lane"}, "ship": {"source": "constant", "value": "hull"}}}
    (tmp_path / "c.json").write_text(json.dumps(good))
    found = config.load_build_config(tmp_path / "c.json", tmp_path)
    assert found.canon_root == str(tmp_path / "canon") and found.schema_dir == "/abs" and found.lane_rules() == {"hero": {"field": "visual.lane"}, "ship": {"lane": "hull"}}
    (tmp_path / "c.json").write_text(json.dumps(good | {"project_id": "", "entity_dirs": [], "schema_to_lane": {"a": {"source": "field"}, "b": {"source": "x"}, "c": 1}}))
    with pytest.raises(config.InputError) as wrong:
        config.load_build_config(tmp_path / "c.json", tmp_path)
    assert all(word in str(wrong.value) for word in ("project_id", "entity_dirs", "of a ", "of b ", "of c "))
    with pytest.raises(config.InputError):
        config.load_build_config(tmp_path / "none.json", tmp_path)
    assert config.time_id("export", datetime.datetime(2026, 1, 31, 23, 59, 58, tzinfo=datetime.timezone.utc), "ab12") == "export-20260131-235958-ab12"


def test_freezes(spark):
    rows_ = [("a", "hero", "auto", '{"visual":{"reference_plate_uri":"x\\\\a.png"}}'), ("b", "ship", "soft-advisory", '{"reference_plate_uri":"y/b.png"}'), ("c", "ship", "frozen", "{}")]
    entries = spark.createDataFrame(rows_, "id string, schema_kind string, freeze_status string, entry string")
    events = canon.freeze_events(entries, "frozen", "done", "me", "2026-01-01").collect()
    assert {(e["entity_id"], e["prior_status"], e["type"]) for e in events} == {("a", "auto", "freeze"), ("b", "soft-advisory", "freeze")}
    assert {e["type"] for e in canon.freeze_events(entries, "auto", "why", "me", "t").collect()} == {"unfreeze"}
    with pytest.raises(config.InputError):
        canon.freeze_events(entries, "frozen", "", "me", "t")
    passed = canon.bypass_events(canon.gate(entries, True, "why"), "why", "me", "2026-01-01", entries).collect()
    assert [(e["entity_id"], e["type"], e["schema_kind"], e["reason"], e["new_status"]) for e in passed] == [("b", "bypass", "ship", "why", "soft-advisory")]
    assets = spark.createDataFrame([("x/a.png",), ("y\\b.png",), ("z",), (None,)], "asset_path string")
    assert {r["asset_path"]: r["id"] for r in canon.of_assets(assets, entries).collect()} == {"x/a.png": "a", "y\\b.png": "b", "z": None, None: None}
    assert {r["subject"]: r["freeze_status"] for r in canon.of_subjects(spark.createDataFrame([("c",), ("q",)], "subject string"), entries).collect()} == {"c": "frozen", "q": None}


@pytest.mark.parametrize(
    ("value", "text"),
    [(1e-7, "1e-7"), (1e-5, "0.00001"), (1.5e-6, "0.0000015"), (123456789012345678901, "123456789012345680000"), (1e21, "1e+21"), (1.25e22, "1.25e+22"), (-0.0, "0"), (-2.5, "-2.5"), (100.0, "100"), (0.1, "0.1"), (5e-324, "5e-324"), (math.inf, "null")],
)
def test_numbers_as_text(value, text):
    assert canon.number_text(value) == text and canon.canonical({"v": value}) == f'{{"v":{text}}}'


def test_numbers_of_texts(spark):
    read = lambda text: one(spark, records.parse_scores(F.lit(text)))
    assert read("a:0.9,a:0.4") == {"a": 0.4} and read("a:0.9x, b: .5e1 ,c:-3.") == {"a": 0.9, "b": 5.0, "c": -3.0} and read("a:x,:1,b,c:,") == {}
    with pytest.raises(Exception, match="not a number"):
        one(spark, records.parse_scores(F.lit("a:x"), strict=True))
    pairs = one(spark, records.parse_pair_scores(F.lit("a:0.9/0.6,a:0.1/0.2x,b:1")))
    assert {k: tuple(v) for k, v in pairs.items()} == {"a": (0.1, 0.2)}


def test_base_records(spark):
    given = spark.createDataFrame([("a", "x.png", 0, None, 7, "p")], "id string, asset_path string, width int, height int, bytes int, provenance string")
    made = records.with_identity(records.base(given, "2026-01-01"), spark.createDataFrame([("a", "i", "l")], "id string, identity string, lineage string")).first()
    assert (made["schema_version"], made["image"].asDict(), made["judgment"], made["identity"]) == ("2.0.0", {"format": "png", "width": 1024, "height": 1024, "bytes": 7}, None, "i")


def test_event_stream(spark, tmp_path):
    events = [("2026-01-01T00:00:00Z", "b1", "freeze", "e1"), ("2026-01-01T00:30:00Z", "b1", "unfreeze", "e1"), ("2026-01-01T05:00:00Z", "b2", "freeze", "e2")]
    frame = spark.createDataFrame(events, "at string, build_hash string, type string, entity_id string")
    writers.append_events(str(tmp_path / "log"), frame)
    with pytest.raises(Exception, match="event without type"):
        writers.append_events(str(tmp_path / "log"), frame.withColumn("type", F.lit(None).cast("string")))
    counted = logs.windowed_counts(logs.freeze_events(spark, str(tmp_path / "log")), "event_time", "type")
    query = counted.writeStream.outputMode("complete").format("memory").queryName("counted").trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert sorted((r["type"], r["n"]) for r in spark.table("counted").collect()) == [("freeze", 1), ("freeze", 1), ("unfreeze", 1)]


def test_inbox_is_idempotent(spark, tmp_path):
    inbox, target = str(tmp_path / "in"), str(tmp_path / "out")
    for k, ids in enumerate((["a", "b"], ["b", "c", "c"])):
        spark.createDataFrame([(i,) for i in ids], "record_id string").write.mode("append").json(inbox)
        logs.ingest_new(spark.readStream.schema("record_id string").json(inbox), target, str(tmp_path / "cp")).awaitTermination(60)
    assert sorted(r[0] for r in spark.read.parquet(target).collect()) == ["a", "b", "c"]


# ---- production loop, upkeep, boxes ----------------------------------------------------------------------


def test_slots_and_refinement(spark):
    done = spark.createDataFrame([("a", "ok", None), ("b", "failed", "x"), ("c", None, "x"), ("d", None, ""), ("e", None, None)], "slot_id string, status string, selected_output string")
    assert sorted(r[0] for r in production.slots_to_run(done.select("slot_id"), done).collect()) == ["b", "d", "e"]
    delta = production.refine_delta(F.array(F.lit("pose")), F.array(F.lit("enforce: x")), F.array(F.lit("[Palette] check: neon"), F.lit("negative check: Blur"), F.lit("negative check: ")))
    row = spark.range(1).select(production.refined_prompt(F.lit("p"), delta).alias("p"), production.refined_negative(F.lit("blur, fog"), delta).alias("n"), production.refined_negative(F.lit(None).cast("string"), delta).alias("m")).first()
    assert tuple(row) == ("p, [preserve: pose], [emphasize: enforce: x]", "blur, fog, neon", "neon, Blur")


def test_scores_and_boxes(spark):
    assert one(spark, records.parse_scores(F.lit("a:0.9, b :x,:1,c:0.25"))) == {"a": 0.9, "c": 0.25}
    assert one(spark, records.parse_pair_scores(F.lit("a:0.9/0.6,b:1,c:x/1")))["a"]["b"] == 0.6
    plans = spark.createDataFrame([("i", 7, 200, 200, k, 40, 30) for k in range(6)] + [("j", 7, 50, 50, 0, 60, 60)], "image string, seed int, width int, height int, ord int, w int, h int")
    placed = boxes.place(plans)
    assert placed.where("placed").count() == 6 and boxes.overlaps(placed.where("placed").withColumnRenamed("ord", "box")).count() == 0
    points = [(r["x"], r["y"]) for r in boxes.scatter(spark.createDataFrame([("i", 3, 100, 80, 12.0)], "image string, seed int, width int, height int, spacing double")).collect()]
    assert len(points) > 20 and all(math.dist(p, q) >= 12 for k, p in enumerate(points) for q in points[:k])
    labels = spark.createDataFrame([("a", 2, 1, [[0, 0, 1, 1]]), ("b", 1, 1, [[-1, 0, 1, 1]]), ("c", 0, 1, None)], schema.BOX_LABEL)
    assert [r["image"] for r in boxes.miscounted(labels).collect()] == ["a"]


def test_doctor_and_snapshot_diff(spark):
    a, b = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int"), spark.createDataFrame([(1,), (3,)], "k int")
    assert [tuple(r) for r in doctor.dangling(a, b, "k", "k").collect()] == [(2, 2)]
    sides = [spark.createDataFrame([(x,) for x in ids], "record_id string") for ids in ("aabc", "bd")]
    assert sorted(map(tuple, snapshot.difference(*sides).collect())) == [("a", "removed"), ("b", "shared"), ("c", "removed"), ("d", "added")]


def test_doctor_counts_every_seventh_line_as_lost(spark, tmp_path):
    lines = [(0, 7, 1), (0, 1, 1), (1, 7, 2), (1, 7, 9), (-2, 7, 1), (2, 1, 2), (5, 1, 1), (None, 7, 1)]  # -0 and 2 are orders, 5 is none
    for name, rows, schema in (("lineitem", lines, "l_orderkey bigint, l_linenumber int, l_partkey bigint"), ("orders", [(0,), (1,), (2,)], "o_orderkey bigint"), ("part", [(1,), (2,)], "p_partkey bigint")):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    database = duckdb.connect()
    for name in ("lineitem", "orders", "part"):
        database.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    expected = database.sql(queries.ORACLES["doctor_referential"]).fetchall()
    assert sorted(map(tuple, queries.doctor_referential(spark, str(tmp_path)).collect())) == sorted(expected)
    assert ("line_order", 3, False) in expected
