import importlib
import os
import shutil
import subprocess
import sys


def test_entry_and_contract(spark):
    m = importlib.import_module("__spark_entry__")
    df = m.entry(spark)
    assert df.count() > 0
    assert set(m.oracle_sql()) <= set(m.queries())
    assert len(m.queries()) >= 70


def test_bench_headline_keys_are_registered():
    import bench
    from paylake.plans.catalog import QUERIES
    assert set(bench.HEADLINE) <= set(QUERIES)


def _keys_of_a_copy(tmp_path, leave_out):
    """Keys that the entry of a copy of the repository, without some parts, registers."""
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    copy = str(tmp_path / "copy")
    shutil.copytree(top, copy, ignore=lambda folder, names: {
        n for n in names if n in (".git", "__pycache__") or os.path.relpath(os.path.join(folder, n), top) in leave_out})
    code = "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries(), any(k.startswith('op1_') for k in e.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120,
                         env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert out.returncode == 0, out.stderr[-2000:]
    return out.stdout.split()


def test_entry_without_the_text_folders(tmp_path):
    from paylake.plans.catalog import QUERIES
    for i, leave_out in enumerate([{"paylake/llm", "tests/llm"}, {"paylake/llm", "tests/llm", "corpus_pipeline.py"}]):
        assert _keys_of_a_copy(tmp_path / str(i), leave_out) == [str(len(QUERIES)), "False", "False"]
