"""Fixed values that results depend on.  They are data contracts, kept as plain text."""

from __future__ import annotations

# Product type by code prefix, and the label of every other prefix.
PRODUCT_TYPE_LABELS = {
    "TEC": "Технопродукты",
    "INT": "Внутренние продукты",
    "PLF": "ИТ-продукты. Платформы",
    "PRO": "ИТ-продукты. Приложения",
    "SRV": "ИТ-продукты. Сервисы",
}
OTHER_PRODUCTS_LABEL = "Внешние продукты (из PPInfo)"
NO_PREFIX = "BPR"

# Classifier id to column of the wide classifier table.
CLASSIFIERS = {
    8: "FINDirectionGeneral",
    9: "FINDirectionDetailed",
    27: "FINGroup",
    28: "FINDetailed",
}

# Journal entries: the staged columns in order.
JOURNAL_COLUMNS = (
    "SEGMENT1",
    "SEGMENT1_DESCRIPTION",
    "SEGMENT2",
    "SEGMENT2_DESCRIPTION",
    "SEGMENT2DT",
    "SEGMENT2DT_DESCRIPTION",
    "SEGMENT2KT",
    "SEGMENT2KT_DESCRIPTION",
    "SEGMENT3",
    "SEGMENT3_DESCRIPTION",
    "SEGMENT4",
    "SEGMENT4_DESCRIPTION",
    "SEGMENT5",
    "SEGMENT5_DESCRIPTION",
    "DESCRIPTION",
    "ACCOUNTING_DATE",
    "CURRENCY_CODE",
    "SUM_OPER",
    "SUM_RUB",
    "RATE_USD_RUB",
    "PERIOD",
    "POSTED_NUMBER",
    "AUTHOR_NAME",
    "REFERENCE2",
    "DEBET",
    "PERIOD_OEBS",
    "CATEGORY_NAME",
    "TASK_NUMBER",
    "ORDER_NUMBER",
    "GEN_CONTRACT",
    "DOC_DATE",
    "AMOUNT_OLAP",
    "BI_DATA_TYPE",
    "BI_PROJECTS_DIRECTION",
    "BI_PROJECTS_TYPE",
    "BI_PL_ITEM",
)
JOURNAL_MONEY = ("SUM_OPER", "SUM_RUB", "RATE_USD_RUB", "AMOUNT_OLAP")
JOURNAL_DATES = ("ACCOUNTING_DATE", "PERIOD_OEBS", "PERIOD", "DOC_DATE")
JOURNAL_TEXT_DEFAULT = "1"
JOURNAL_DROPPED = "REFERENCE2GUID"

# Act export: output field by view column, in order.  ``CurrenrId`` is how the receiver spells it.
ACT_EXPORT = {
    "id": "id",
    "ProjectId": "ProjectId",
    "ProjectCode": "ProjectCode",
    "CustomerId": "CustomerId",
    "ContractorId": "ContractorId",
    "CurrencyId": "CurrenrId",
    "ContractId": "ContractId",
    "ContractName": "ContractName",
    "ContractFrame": "ContractFrame",
    "ContractCount": "ContractCount",
    "Date": "Date",
    "StartPeriodDate": "StartPeriodDate",
    "EndPeriodDate": "EndPeriodDate",
    "ActStatus": "ActStatus",
    "ActNumber": "ActNumber",
    "ActType": "ActType",
    "Hyperion": "Hyperion",
    "TaskOebsName": "TaskOebsName",
    "CapexOpex": "CapexOpex",
    "CostSegmentCode": "CostSegmentCode",
    "ResponsibilityCenterCode": "ResponsibilityCenterCode",
    "WIPCustomerCluster": "WIPCustomerCluster",
    "Amount": "Amount",
    "SumFot": "SumFot",
    "SumMargin": "SumMargin",
    "SumLeaders": "SumLeaders",
    "SumOverheadCosts": "SumOverheadCosts",
}

# Plan-hours history: the name of the source and the stored columns in order.
PLAN_HOURS_SOURCE = "RMS"
PLAN_HOURS_COLUMNS = (
    "ProjectCode",
    "LegalEntityId",
    "TribeId",
    "RoleId",
    "CompetenceId",
    "Period",
    "Type",
    "SubType",
    "ChangeDate",
    "ChangedBy_EmployeeCode",
    "Comment",
    "Increment",
    "SourceSystem",
    "LoadDateTime",
)
