"""The entry module outside its folder and without its optional part."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def run(code, cwd):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    return subprocess.run([sys.executable, "-c", code], cwd=cwd, env=env, capture_output=True, text=True, timeout=300)


def test_workers_get_the_package(tmp_path):
    """Started elsewhere, the Python workers still import the package."""
    code = (f"import sys; sys.path.insert(0, {ROOT!r})\n"
            "import __spark_entry__ as e\n"
            "from pyspark.sql import SparkSession\n"
            "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
            "print('ROWS', e.queries()['vector_topk_cosine'](s, '/root/testdata/sf0.001').count(),\n"
            "      e.queries()['insert_with_embedding'](s, '/root/testdata/sf0.001').count())")
    out = run(code, tmp_path)
    assert "ROWS 10 200" in out.stdout, out.stderr[-2000:]


def test_entry_without_the_optional_part(tmp_path):
    shutil.copytree(os.path.join(ROOT, "shoreline"), tmp_path / "shoreline",
                    ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    out = run("import __spark_entry__ as e; q = e.queries(); print('OK', len(q) > 40, [k for k in q if k.startswith('op')])", tmp_path)
    assert "OK True []" in out.stdout, out.stderr[-2000:]


def test_entry_without_a_package_of_the_optional_part(tmp_path):
    """A package that only the optional part needs is absent: the core queries stay, with a warning."""
    code = (f"import sys; sys.path.insert(0, {ROOT!r}); sys.modules['xxhash'] = None\n"
            "import warnings; warnings.simplefilter('always')\n"
            "import __spark_entry__ as e; q = e.queries(); print('OK', len(q) > 40, [k for k in q if k.startswith('op')])")
    out = run(code, tmp_path)
    assert "OK True []" in out.stdout and "training-data operators left out" in out.stderr, out.stderr[-2000:]


def test_checkpoint_folder_is_required_on_a_cluster():
    from shoreline import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()
    try:
        session.checkpoint_root(Session())
    except RuntimeError as e:
        assert "spark.checkpoint.dir" in str(e)
    else:
        raise AssertionError("a cluster without a shared folder must be refused")
