"""Bronze table schemas and the NULL-token list.

Bronze keeps every column as it appears in the source files.  Years and
runtimes stay strings; staging converts them with tolerant casts.
"""

from pyspark.sql import types as T

S = T.StringType()
L = T.LongType()

TITLE_BASICS = T.StructType([
    T.StructField("tconst", S),
    T.StructField("titleType", S),
    T.StructField("primaryTitle", S),
    T.StructField("originalTitle", S),
    T.StructField("isAdult", T.IntegerType()),
    T.StructField("startYear", S),
    T.StructField("endYear", S),
    T.StructField("runtimeMinutes", S),
    T.StructField("genres", S),
])

TITLE_RATINGS = T.StructType([
    T.StructField("tconst", S),
    T.StructField("averageRating", T.DoubleType()),
    T.StructField("numVotes", L),
])

NAME_BASICS = T.StructType([
    T.StructField("nconst", S),
    T.StructField("primaryName", S),
    T.StructField("birthYear", S),
    T.StructField("deathYear", S),
    T.StructField("primaryProfession", S),
    T.StructField("knownForTitles", S),
])

TITLE_CREW = T.StructType([
    T.StructField("tconst", S),
    T.StructField("directors", S),
    T.StructField("writers", S),
])

TITLE_PRINCIPALS = T.StructType([
    T.StructField("tconst", S),
    T.StructField("ordering", L),
    T.StructField("nconst", S),
    T.StructField("category", S),
    T.StructField("job", S),
    T.StructField("characters", S),
])

# Loaded but never used by a model; their columns are read as strings.
TITLE_AKAS = T.StructType([T.StructField(c, S) for c in (
    "titleId", "ordering", "title", "region", "language", "types",
    "attributes", "isOriginalTitle")])
TITLE_EPISODE = T.StructType([T.StructField(c, S) for c in (
    "tconst", "parentTconst", "seasonNumber", "episodeNumber")])

BRONZE_SCHEMAS = {
    "title_basics": TITLE_BASICS,
    "title_ratings": TITLE_RATINGS,
    "name_basics": NAME_BASICS,
    "title_crew": TITLE_CREW,
    "title_principals": TITLE_PRINCIPALS,
    "title_akas": TITLE_AKAS,
    "title_episode": TITLE_EPISODE,
}

# Source file names use dots ("title.basics.tsv.gz"); tables use underscores.
def table_id(dotted: str) -> str:
    return dotted.replace(".", "_")


# The missing-value marker of the source files plus the default
# NA strings of the pandas CSV reader, which the original loader applied to
# every column.
SOURCE_NULL = "\\N"
PANDAS_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
DEFAULT_NA_TOKENS = (SOURCE_NULL,) + PANDAS_NA_TOKENS
STRICT_NA_TOKENS = (SOURCE_NULL,)
