"""Parameters of the registered queries (shared by the Spark jobs and the
oracle SQL so both sides state the same question)."""

from tidepool.sources.tables import DRIVER_SEEDS

NATIONALITY = "NATION_7"
TOP_K = 10
# The driver's access log spans 30 days and every user is active throughout,
# so the library default of 14 days finds nobody; one day gives a real answer.
INACTIVE_DAYS = 1
SEEDS = DRIVER_SEEDS
KMEANS_STEPS = 5
KMEANS_MAX_STEPS = 500  # a bound for the loop; the driver's tables converge in 6 to 74 steps
KMEANS_TOL = 0.001
MANY_CENTRES = 2000  # centres of the grid query: the most frequent places
ROLLING_DAYS = 7
STATE_MERGES = 3  # equal periods of the log, merged into the state of last accesses one by one
CHUNK_WIDTH = 16  # friend ids a chunk spans: the smallest driver tables have 9 friend ids
