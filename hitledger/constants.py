"""They must stay as they are for results to be right."""

# The three readings of a Common Log Format line.
STRICT = (
    r'^(\S+) - - \[(\d{2}/\w{3}/\d{4}:\d{2}:\d{2}:\d{2} -\d{4})\] '
    r'"(\S+) (\S+) (\S+)" (\d{3}) (\d+|-)'
)
LOOSE = r'^\S+ - - \[(.*?)\] ".*?\s(\S+)\s.*?" (\d{3})'
STREAM = r'^(\S+) - - \[(.*?)\] "(.*?) (.*?) (.*?)" (\d+) (\d+|-)'

# Time formats inside the brackets of a line.
DAY_FORMAT = "dd/MMM/yyyy"
TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"

# Month names as a log writes them.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")

# Page filters.
PAGE_REGEX = r"(?i)\.html?$"
PAGE_SUFFIXES = (".html", ".htm")
PAGE_TEXT = ".html"

# Report parameters.
STATUSES = (200, 404, 500)
TOP_PAGES = 10
TOP_METRICS = 15
PREVIEW_ROWS = 5
SIGMAS = 2
WINDOW = "24 hours"

# Wording of the text report.
REPORT_LABELS = {
    "url": "URL: ",
    "total": "  Всего запросов: ",
    "shares": "  Распределение: ",
    "share": "статус %d - всего %d запросов, %.2f%%",
    "high": "  Аномально много: ",
    "low": "  Аномально мало: ",
    "none": "нет",
    "rule": "-" * 30,
}
