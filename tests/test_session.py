import pytest

from storeloom.session import LOCAL_FOLDER, scratch_path, scratch_root


class Conf(dict):
    def set(self, key, value):
        assert key != "spark.checkpoint.dir", "Spark refuses to change it at run time"
        self[key] = value


class Session:
    def __init__(self, **options):
        self.conf = Conf({key.replace("__", "."): value for key, value in options.items()})


def test_the_folder_the_cluster_names_is_used():
    session = Session(spark__master="yarn", spark__checkpoint__dir="hdfs:///shared/")
    assert scratch_root(session) == "hdfs:///shared/"
    one, two = scratch_path(session, "x"), scratch_path(session, "x")
    assert one.startswith("hdfs:///shared/x-") and one != two


def test_a_cluster_without_a_folder_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(Session(spark__master="yarn"))


def test_a_cluster_folder_needs_a_scheme():
    with pytest.raises(ValueError, match="scheme"):
        scratch_root(Session(spark__master="yarn", spark__checkpoint__dir="/tmp/checkpoints"))


def test_local_mode_makes_one_folder():
    session = Session(spark__master="local[2]")
    assert scratch_root(session) == scratch_root(session) == session.conf[LOCAL_FOLDER]


def test_a_real_session_takes_the_local_folder(spark):
    before = spark.conf.get(LOCAL_FOLDER, None)
    spark.conf.set(LOCAL_FOLDER, "x")
    assert spark.conf.get(LOCAL_FOLDER) == "x"
    spark.conf.unset(LOCAL_FOLDER) if before is None else spark.conf.set(LOCAL_FOLDER, before)


class Context:
    """What a cluster's context knows: the folder Spark made of the one it was given, and settings."""

    def __init__(self, folder=None, **settings):
        self.folder = folder
        self.settings = {key.replace("__", "."): value for key, value in settings.items()}

    def getCheckpointDir(self):
        return self.folder

    def getConf(self):
        return self.settings


def test_a_folder_without_a_scheme_is_the_one_the_cluster_made_of_it():
    session = Session(spark__master="spark://head:7077", spark__checkpoint__dir="/tmp/checkpoints")
    session.sparkContext = Context("hdfs://head/tmp/checkpoints/1f")
    assert scratch_root(session) == "hdfs://head/tmp/checkpoints/1f"
    session.conf["spark.master"] = "local[2]"
    assert scratch_root(session) == "hdfs://head/tmp/checkpoints/1f"
    session.sparkContext = Context()
    assert scratch_root(session) == "/tmp/checkpoints"


def test_the_folder_given_to_the_context_is_used():
    for master in ("spark://head:7077", "local-cluster[2,1,1024]", "local[2]"):
        session = Session(spark__master=master)
        session.sparkContext = Context("file:/shared/1f")
        assert scratch_root(session) == "file:/shared/1f"


def test_a_cluster_without_a_folder_for_checkpoints_takes_the_warehouse():
    for master in ("spark://head:7077", "local-cluster[2,1,1024]"):
        session = Session(spark__master=master, spark__sql__warehouse__dir="file:/shared/tables")
        session.sparkContext = Context(spark__sql__warehouse__dir="/shared/tables")
        assert scratch_root(session) == "file:/shared/tables/storeloom_scratch"
    session.sparkContext = Context()
    session.conf["spark.master"] = "spark://head:7077"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(session)  # the default warehouse may be a folder of the driver alone


def test_the_local_folder_is_local_whatever_the_default_file_system():
    assert scratch_root(Session(spark__master="local[2]")).startswith("file:///")


def test_a_real_context_names_its_folder(spark):
    found = spark.sparkContext.getCheckpointDir()
    assert found.startswith("file:/")
    session = Session(spark__master="spark://head:7077", spark__checkpoint__dir="/unused")
    session.sparkContext = spark.sparkContext
    path = scratch_path(session, "rows")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
