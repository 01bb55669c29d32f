"""Parameters of the registered queries (years, users, service, k).

The test tables cover 1995-2001; the analyst questions of the warehouse are
asked of years inside that range.
"""

# fixed values: query parameters
SLICE_YEAR = 1997            # one-year ODS slices, flagship mart year
TOP_YEAR = 2000              # top-20 downloaders, issues of a service
TOP_SERVICE = "R"
AVG_YEAR = 1999              # users above the year's average
MIN_YEAR = 2000              # user with the smallest maximum, and their payments
BOTTOM_YEAR = 1995           # bottom-10
COUNT_YEAR = 2001            # row counts of chosen users
CHOSEN_USERS = (10, 100, 250, 499, 733, 1000)
YEARS_AFTER = 1997           # HAVING year > 1997
BETWEEN_YEARS = (1995, 1997)
RERUN_YEARS = (1995, 1996, 1997)  # loaded in order, then the middle year is run again
RERUN_YEAR = 1996
