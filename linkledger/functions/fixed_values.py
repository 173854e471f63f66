"""Fixed values the results depend on.

These words, patterns and numbers are part of the inventory's contract: changing one
changes which rows are called cloud, outbound, inbound and so on.
"""

# Connectors that count as cloud even behind a gateway.
CLOUD_CONNECTORS = (
    "azuresqldatabase", "sqlserverless", "synapse", "kusto",
    "onelake", "adls", "abfss", "s3", "rest",
    "sharepointonline", "dynamics365", "salesforce", "snowflake",
    "fabriclakehouse",
)

# Direction patterns, tested as substrings in this order of groups.
OUTBOUND_CONNECTOR_PARTS = (
    "snowflake", "salesforce", "dynamics365", "rest", "web",
    "azuresqldatabase", "s3", "oracle", "mysql", "postgresql",
    "sharepoint", "kusto", "synapse",
)
INTERNAL_CONNECTOR_PARTS = ("onelake", "fabriclakehouse", "lakehouse")
EXTERNAL_DOMAINS = (
    ".windows.net", ".snowflakecomputing.com",
    ".salesforce.com", ".dynamics.com", ".azure.com",
)
INTERNAL_SERVER_PARTS = ("onelake", "fabric")

# Activities that count as access from outside, and the browser prefix.
INBOUND_ACTIVITIES = (
    "GetDataset", "ExecuteQueries", "AnalyzeInExcel",
    "ExportReport", "ViewReport", "GetTile",
    "GenerateEmbedToken", "GetDashboard",
)
BROWSER_PREFIX = "Mozilla"

# Workspace owners, kinds and capacity labels.
OWNER_RIGHTS = ("Admin", "Member")
PERSONAL_TYPE = "PersonalGroup"
UNKNOWN = "unknown"
SHARED_CAPACITY = "Shared"
SHARED_KEY = "shared"
SCOPE_CLOUD = "Cloud"
SCOPE_GATEWAY = "OnPremViaGateway"

# Item types, as spelled after lower-casing, per reading rule.
SEMANTIC_TYPES = ("semanticmodel", "dataset")
DATAFLOW_TYPES = ("dataflow",)
ACTIVITY_TYPES = ("pipeline",)
REFERENCE_TYPES = ("lakehouse", "notebook")

# Sizes and thresholds.
WORKSPACES_PER_BATCH = 100
CALLS_PER_BATCH = 8
RECENT_HOURS = 24
HOURLY_LIMIT = 500
RATE_WARNING = 450
RATE_MODERATE = 350
MAX_WHOLE_FILE = 2_000_000_000
