"""Schemas and fixed values.

Column names are the defaults of every operator; each operator also takes them as parameters.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------------------------
# Schemas
# --------------------------------------------------------------------------------------------

CORRUPT_COLUMN = "_corrupt_record"
_S = T.StringType()


def _struct(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n.rstrip("_"), k) for n, k in kinds.items()])


# Raw vacancy as collected. Salary bounds are read as text so that a float or a quoted number
# in one file does not turn the whole record into a corrupt row; they are cast leniently later.
RAW_SCHEMA = _struct(
    id=_S, name=_S, salary=_struct(from_=_S, to=_S, currency=_S, gross=T.BooleanType()),
    area=_struct(id=_S, name=_S), employer=_struct(id=_S, name=_S),
    snippet=_struct(requirement=_S, responsibility=_S), published_at=_S, collected_at=_S)
RAW_DDL = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW_SCHEMA.fields)

# Envelope of one page of search results.
PAGE_DDL = f"items ARRAY<STRUCT<{RAW_DDL}>>, found INT, pages INT, page INT"

# Text pattern of window bounds in reports (a literal Z, session time zone UTC).
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"

# --------------------------------------------------------------------------------------------
# Fixed values. These must equal the behaviour being reproduced; keep them as written.
# --------------------------------------------------------------------------------------------

# Keywords of the literal, ASCII-case-insensitive substring match (tumbling-window top skills).
LITERAL_SKILLS = [
    "Python", "Go", "Golang", "Java", "JavaScript", "TypeScript", "React", "Vue",
    "SQL", "PostgreSQL", "MySQL", "MongoDB", "Redis", "Kafka", "Docker", "Kubernetes",
    "CI/CD", "Git", "Linux", "AWS", "GCP", "Azure", "REST", "gRPC", "Rust",
    "C++", "C#", ".NET", "PHP", "Ruby", "Swift", "Kotlin", "Scala",
]

# Keywords of the dashboard skill chart: each is used as an unescaped, case-insensitive regex.
REGEX_SKILLS = [
    "Python", "Go", "Java", "JavaScript", "TypeScript", "React", "Vue",
    "SQL", "PostgreSQL", "MySQL", "MongoDB", "Redis", "Kafka", "Docker",
    "Kubernetes", "Git", "Linux", "AWS", "REST", "gRPC", "Rust", "C++",
]

# Salary bands: (upper bound exclusive, label); the last label takes everything else.
SALARY_BANDS_5 = [(50000, "< 50K"), (100000, "50K-100K"), (200000, "100K-200K"),
                  (300000, "200K-300K"), (None, "> 300K")]
SALARY_BANDS_4 = [(50000, "< 50K"), (100000, "50K-100K"), (200000, "100K-200K"),
                  (None, "> 200K")]

# Validation rules and their messages, in the order they are reported.
MIN_NAME_BYTES = 3
MAX_NAME_BYTES = 500          # extended profile only
MAX_SALARY_TO = 10_000_000
MSG_NAME_SHORT = "name too short (min 3 chars)"
MSG_NAME_LONG = "name too long (max 500 chars)"
MSG_FROM_NEGATIVE = "salary_from cannot be negative"
MSG_FROM_GT_TO = "salary_from > salary_to"
MSG_FROM_GT_TO_EXT = "salary_from (%d) > salary_to (%d)"
MSG_TO_TOO_HIGH = "salary_to > 10M RUB (unrealistic)"
MSG_TO_TOO_HIGH_EXT = "salary_to %d > 10M RUB (unrealistic)"
MSG_AREA_MISSING = "area_id is required"

# Collection shards: (shard id, area id, area name, query).
SHARDS = [
    (1, "1", "Москва", "разработчик"),
    (2, "2", "Санкт-Петербург", "разработчик"),
    (3, "3", "Екатеринбург", "разработчик"),
    (4, "66", "Новосибирск", "разработчик"),
    (5, "1", "Москва", "data engineer"),
    (6, "2", "Санкт-Петербург", "data engineer"),
]

# Defaults of the streaming and reporting operators.
TUMBLING_WINDOW = "60 seconds"
SLIDING_WINDOW = "300 seconds"
SLIDING_REPORT_EVERY = "10 seconds"
FILE_FLUSH_ROWS = 50
FILE_FLUSH_EVERY = "10 seconds"
TOP_SKILLS_N = 10
BYTES_PER_ROW_ESTIMATE = 100
