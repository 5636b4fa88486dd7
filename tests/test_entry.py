import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_sql_belongs_to_queries():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries()) and "gap_detect" in entry.queries()


def test_nothing_else_imports_the_training_data_package():
    for path in (ROOT / "shardloom").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "shardloom.llm" not in path.read_text()


def test_entry_works_without_the_training_data_package(tmp_path):
    for path in [ROOT / "__spark_entry__.py", *(ROOT / "shardloom").rglob("*.py")]:
        relative = path.relative_to(ROOT)
        if "llm" not in relative.parts:
            (tmp_path / relative).parent.mkdir(parents=True, exist_ok=True)
            (tmp_path / relative).write_bytes(path.read_bytes())
    code = "import __spark_entry__ as e; print(len(e.queries()), sorted(q for q in e.queries() if q.startswith('op')), 'pipeline' in e.queries())"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True).stdout
    assert "False" in out and "op1_" not in out


def test_entry_query(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
