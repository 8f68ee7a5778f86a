"""Row estimates from byte ranges."""

import random

from tallyloom.sources import files as fl


def test_estimates_hold_against_the_exact_count(spark, tmp_path):
    rng = random.Random(8)
    exact = {}
    for n in range(30):
        rows = ["x" * rng.randint(1, 20 + 150 * (k > 3_000)) for k in range(rng.randint(2_000, 6_000))]
        text = "\n".join(rows) + "\n" * (n % 2)
        (tmp_path / f"f{n}.csv").write_text(text)
        exact[f"f{n}.csv"] = len(rows)
    samples = {r["name"]: r for r in fl.row_samples(spark, str(tmp_path), 16, 2048, seed=3).collect()}
    assert set(samples) == set(exact)
    for name, r in samples.items():
        assert r.bytes_read == min(r.bytes, 16 * 2048) + 1
        assert abs(r.rows - exact[name]) <= r.error < 0.9 * exact[name]
        assert 5 < r.bytes_a_row < 150
    total = fl.sampled_totals(fl.row_samples(spark, str(tmp_path), 16, 2048, seed=3)).first()
    assert total.files == 30 and abs(total.rows - sum(exact.values())) <= total.error < 0.15 * total.rows
    again = {r["name"]: r for r in fl.row_samples(spark, str(tmp_path), 16, 2048, seed=3).repartition(3).collect()}
    assert again == samples


def test_small_files_are_exact(spark, tmp_path):
    for name, text in {"a.csv": "", "b.csv": "x", "c.csv": "x\ny\n", "d.csv": "\n" * 500}.items():
        (tmp_path / name).write_text(text)
    found = {r["name"]: (r.rows, r.error) for r in fl.row_samples(spark, str(tmp_path)).collect()}
    assert found == {"b.csv": (1, 0), "c.csv": (2, 0), "d.csv": (500, 0)}
