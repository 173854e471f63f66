"""Explicit schemas of everything the library reads and writes.

Nothing is inferred: a column that happens to be all null keeps its type.
"""

from __future__ import annotations

from pyspark.sql import types as T

#: Columns that identify one connection. Nulls compare equal in this key.
CONNECTION_KEY = ["workspace_id", "item_id", "connector", "server", "database", "endpoint"]

CONNECTION_COLUMNS = [
    "workspace_id", "workspace_name", "workspace_kind", "workspace_users",
    "capacity_id", "capacity_name", "is_dedicated_capacity",
    "item_id", "item_name", "item_type", "item_creator",
    "item_modified_by", "item_modified_date",
    "connector", "target", "server", "database", "endpoint",
    "connection_scope", "cloud", "generation",
]

CONNECTION_SCHEMA = T.StructType([
    T.StructField(c, T.BooleanType() if c in ("is_dedicated_capacity", "cloud") else T.StringType())
    for c in CONNECTION_COLUMNS
])

FINGERPRINT_COLUMNS = [
    "workspace_id", "workspace_name", "workspace_type", "connection_hash", "last_scan_time",
]
FINGERPRINT_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in FINGERPRINT_COLUMNS])

WORKSPACE_SOURCE_COLUMNS = ["workspace_id", "workspace_name", "workspace_type", "capacity_id"]

# One reference inside an item. The item kinds spell their references differently; a
# superset keeps all of them in one array type, so a payload is exploded once.
# gatewayId and isCloud stay VARIANT because their truth depends on the JSON type, and a
# missing isCloud differs from an explicit null.
REFERENCE_DDL = (
    "struct<gatewayId:variant,"
    "connectionDetails:struct<datasourceType:string,server:string,host:string,database:string,db:string>,"
    "type:string,provider:string,url:string,path:string,endpoint:string,isCloud:variant,"
    "linkedService:struct<type:string,url:string,endpoint:string,gatewayId:variant>>"
)

ITEM_DDL = (
    "struct<id:string,name:string,type:string,createdBy:string,configuredBy:string,"
    "modifiedBy:string,modifiedDateTime:string,generation:string,"
    "properties:struct<generation:string>,"
    + ",".join(
        f"{part}:array<{REFERENCE_DDL}>"
        for part in ("datasources", "sources", "entities", "activities", "connections", "lineage")
    )
    + ">"
)

USER_DDL = (
    "struct<emailAddress:string,identifier:string,"
    "workspaceUserAccessRight:string,groupUserAccessRight:string>"
)

WORKSPACE_DDL = (
    "struct<id:string,name:string,type:string,capacityId:string,capacityName:string,"
    f"isOnDedicatedCapacity:boolean,modified:string,users:array<{USER_DDL}>,items:array<{ITEM_DDL}>>"
)

# The sidecar's inner object is read as a map: an absent field and an explicit null
# have different defaults.
PAYLOAD_DDL = (
    f"struct<workspaces:array<{WORKSPACE_DDL}>,"
    "workspace_sidecar:map<string,map<string,string>>>"
)

ACTIVITY_DDL = (
    "struct<Activity:string,CreationTime:string,UserId:string,ClientIP:string,UserAgent:string,"
    "WorkspaceId:string,WorkspaceName:string,DatasetId:string,DatasetName:string,"
    "ReportId:string,ReportName:string,IsSuccess:boolean>"
)
