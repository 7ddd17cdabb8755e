"""Raw feeds: sets of Parquet chunk files with one layout per feed."""
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException

from postlens.constants import COMMUNITY_COLUMNS, ID_COLUMNS, LABEL_COLUMNS, SCORE_COLUMNS, TEXT_COLUMNS, TIME_COLUMNS
from postlens.operators.normalize import normalize, unite, with_default

ROLE_COLUMNS = {*TEXT_COLUMNS, *TIME_COLUMNS, *ID_COLUMNS, *LABEL_COLUMNS, *SCORE_COLUMNS, *COMMUNITY_COLUMNS}
FOOTERS_AT_ONCE = 32


@dataclass(frozen=True)
class Feed:
    """One raw feed: its name, file pattern and the optional fields it provides."""
    name: str
    path: str
    labels: bool = False
    community: bool = False
    default_community: str | None = None
    merge_schema: bool = False   # reads every footer; only for chunks whose columns differ
    mixed_types: bool = False    # reads every footer; only for chunks that store a column in different types


def standard_feeds(raw_dir):
    """The two feeds of the standard chunk folder."""
    return [Feed("twitter", f"{raw_dir}/tweets_chunk_*.parquet", labels=True),
            Feed("reddit", f"{raw_dir}/reddit_chunk_*.parquet", community=True)]


def scan_feed(spark, feed):
    """Raw rows of one feed."""
    df = spark.read.option("mergeSchema", feed.merge_schema).parquet(feed.path)
    return with_default(df, "subreddit", feed.default_community) if feed.default_community else df


def chunk_files(spark, pattern):
    """Paths of the data files behind a pattern, in folders too."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    system = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    found, hidden = [], ("_", ".")
    for match in system.globStatus(hadoop) or []:
        files = system.listFiles(match.getPath(), True)
        while files.hasNext():
            path = files.next().getPath()
            if not path.getName().startswith(hidden) and "/_temporary/" not in path.toString():
                found.append(path.toString())
    return sorted(found)


def footer_types(spark, path):
    """Names and types of the columns a chunk has for the fields of a post, from its footer."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    file = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(path), conf)
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(file)
    try:
        schema = reader.getFooter().getFileMetaData().getSchema()
        fields = [schema.getType(i) for i in range(schema.getFieldCount())]
        return frozenset((f.getName(), f.toString()) for f in fields if f.getName().lower() in ROLE_COLUMNS)
    finally:
        reader.close()


def scan_types(spark, feed):
    """Raw rows of one feed as a DataFrame for each set of column types its chunks have.

    Only footers are read for this, a few dozen at a time. Columns without a part in a post may differ freely.
    """
    files = chunk_files(spark, feed.path)
    groups = defaultdict(list)
    with ThreadPoolExecutor(FOOTERS_AT_ONCE) as pool:
        for path, types in zip(files, pool.map(lambda f: footer_types(spark, f), files), strict=True):
            groups[types].append(path)
    tables = [spark.read.parquet(*groups[types]).select(*[f"`{name}`" for name, _ in sorted(types)])
              for types in sorted(groups, key=sorted)]
    return [with_default(t, "subreddit", feed.default_community) if feed.default_community else t for t in tables]


def load_feeds(spark, feeds):
    """All feeds as unified posts. A feed without files is an error that names every pattern looked for."""
    parts = []
    for feed in feeds:
        try:
            raw, reason = scan_types(spark, feed) if feed.mixed_types else [scan_feed(spark, feed)], None
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            raw, reason = [], error
        if not raw:
            raise FileNotFoundError(f"no files for feed {feed.name!r}; needed: " + ", ".join(f.path for f in feeds)) from reason
        parts += [normalize(rows, feed.name, feed.labels, feed.community) for rows in raw]
    return unite(parts)
