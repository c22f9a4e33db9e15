"""Messages from a template table: one row per message kind, branch and language."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Message texts with placeholders. ``{lender}`` and ``{pay_url}`` are the user's own.
ACCOUNT_TEMPLATES = [
    ("vulnerable", "english",
     "Respected Member (Client #{account}), this is {officer} from your Credit Union Member Welfare desk. We acknowledge your valued loyalty. "
     "We noticed an overdue instalment of {amount} FCFA on Loan Ref #{loan}. Please be reassured that our cooperative offers flexible hardship "
     "restructuring. You are warmly invited to visit our branch or call us to arrange an amicable repayment schedule that protects your household."),
    ("vulnerable", "pidgin",
     "Mami/Papa (Client #{account}), we salute you with plenty respect! Na {officer} from Credit Union Welfare team. We know say sickness, market "
     "slowdown, or family matter fit hold person. Your loan ref #{loan} get small balance of {amount} FCFA, but no worry or fret at all. Credit Union "
     "na our own family bank; when body strong, pass for branch make we sit down arrange small-small payment wey hand fit reach."),
    ("self_curer", "english",
     "Dear Member (Client #{account}), polite reminder from your Credit Union: your instalment of {amount} FCFA for Loan Ref #{loan} is 15 days past "
     "due. Kindly process payment via branch counter or mobile collection to maintain your high credit standing. Thank you!"),
    ("self_curer", "pidgin",
     "Quick reminder from Credit Union to Client #{account}: your loan ref #{loan} get small balance of {amount} FCFA wey reach 15 days now. We know "
     "say work choke; kindly drop am for counter or give mobile collector make your credit file continue di shine. We appreciate plenty!"),
    ("standard", "english",
     "Good day Member (Client #{account}), this is {officer} from your Credit Union Collections Unit. We are following up on Loan Ref #{loan} with an "
     "overdue balance of {amount} FCFA. We value your enterprise and want to help you avoid delinquency fees. Please contact me directly today or "
     "visit the branch before Friday market close to confirm your payment commitment."),
    ("standard", "pidgin",
     "A beg Client #{account}, Credit Union di salute you well-well! Na officer {officer} di check how business di waka. We see say small delay fit "
     "hold your contri loan ref #{loan} for {amount} FCFA wey done pass 15 days. No vex, make you come branch make we sit down arrange payment plan so "
     "that you no go pay penalty fee. Call me back sharp-sharp make we arrange am."),
]
SPONSOR_TEMPLATE = (
    "Dear Family Guarantor / Sponsor, this is {officer} from the Credit Union ({branch}). We are reaching out with respect regarding the cooperative "
    "facility for your family member (Client #{account}, Loan Ref #{loan}). An outstanding balance of {amount} FCFA is currently 15 days past due. To "
    "safeguard your family's credit standing and prevent collateral action, payment can be settled remotely from Douala, Yaoundé, or abroad via MTN "
    "MoMo ({mtn}), Orange Money ({orange}), or direct bank transfer. Kindly contact our desk for confirmation."
)
CALL_TEMPLATES = [
    ("vulnerable", "pidgin",
     "Salute Mami/Papa! Na Voice Assistant from Credit Union Welfare Desk. We di check on you for loan #{loan}. Press 1 if you want make we arrange "
     "soft payment plan of {daily} FCFA per day. Press 2 make Credit Union Officer {officer} call you directly for phone."),
    ("standard", "pidgin",
     "A beg salute Client #{account}! Na Credit Union Collections Voice AI. Your loan ref #{loan} get balance of {amount} FCFA. Press 1 for instant "
     "MTN MoMo PIN prompt to your phone. Press 2 for 30-day small-small plan of {daily} FCFA per day. Press 3 for record audio promise to pay date."),
]
STEP_TEMPLATES = [
    (1, "French", "Cher(e) {name},\n\nNous vous rappelons que votre remboursement de *{amount} FCFA* est dû. Veuillez effectuer votre paiement dès que "
     "possible pour maintenir votre bon dossier de crédit.\n\nPaiement rapide : {pay_url}\n\nMerci de votre confiance.\n— {lender}"),
    (3, "Pidgin", "Bother {name}!\n\nWe remember say yu get *{amount} FCFA* wey yu owe. No worry, e easy to pay now. Click dis link make yu pay with "
     "MoMo or Orange Money:\n{pay_url}\n\nIf yu get problem, call we officer. We de here help yu. Make we sort am together!\n— {lender}"),
    (7, "French + Pidgin", "Cher(e) {name},\n\nNous comprenons que les difficultés financières peuvent survenir. Nous vous proposons un arrangement "
     ":\n\n✅ *Option Flexible :*\n   • Payez {half} FCFA maintenant\n   • {half} FCFA le mois prochain\n\nPour accepter, payez {half} FCFA ici : "
     "{pay_url}\n\n[Pidgin] Bother, we fit help yu. Pay {half} FCFA now, den {half} FCFA next month. Link: {pay_url}\n\n— {lender}"),
    (15, "French", "Cher(e) {name},\n\nMalgré nos rappels, votre solde impayé de *{amount} FCFA* n'a pas encore été réglé. Un agent de notre "
     "coopérative vous rendra visite prochainement pour discuter d'une solution.\n\nPour éviter cette démarche, payez maintenant : {pay_url}\n\n— {lender}"),
]
# Payment codes, the lender's code as in the reference data.
MTN_CODE, ORANGE_CODE, LENDER_CODE = "*126*9*{code}*{whole}#", "*150*1*{code}*{whole}#", "705001"
PAY_INSTRUCTIONS = [
    ("english", "Dial {mtn} (MTN) or {orange} (Orange) to settle Loan Ref #{loan}."),
    ("pidgin", "Dial {mtn} for MTN or {orange} for Orange make you settle loan #{loan} sharp-sharp."),
]


def fill(template: Column, values: Mapping[str, Column]) -> Column:
    """Replace every placeholder by the row's value."""
    out = template
    for name, v in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), v.cast("string"))
    return out


def render_templates(df: DataFrame, templates: Sequence[tuple], columns: str, on: Sequence[str], values: Mapping[str, Column], name: str = "message") -> DataFrame:
    """One message per row and matching template; the template table has a handful of rows."""
    dim = df.sparkSession.createDataFrame(list(templates), columns)
    return df.join(F.broadcast(dim), list(on)).withColumn(name, fill(F.col("template"), values)).drop("template")


def officer_first_name(officer: Column) -> Column:
    return F.substring_index(F.substring_index(officer, " - ", -1), " ", 1)


def message_branch(vulnerable: Column, segment: Column) -> Column:
    return F.when(vulnerable, "vulnerable").when(segment.contains("Self-Curer"), "self_curer").otherwise("standard")


def payment_codes(debt: Column, code: str = LENDER_CODE) -> dict[str, Column]:
    whole = F.bround(debt, 0).cast("bigint").cast("string")
    values = {"code": F.lit(code), "whole": whole}
    return {"mtn": fill(F.lit(MTN_CODE), values), "orange": fill(F.lit(ORANGE_CODE), values)}
