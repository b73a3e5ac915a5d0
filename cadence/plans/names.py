"""Names the jobs look up in the conversion, source and team dimensions.

The conversion / source / team dimensions are maintained outside the jobs; these
names must equal their rows. Product-specific names are parameters of
:class:`Names` so a deployment passes its own.
"""

from __future__ import annotations

from dataclasses import dataclass


# Conversion descriptions shared by every deployment, as stored in
# the conversion dimension.
FILING_A_BUG = "Filing a bug"
SUBMITTING_PATCH = "Submitting patch"
PATCH_APPROVED = "Having patch be approved"
CHANGE_PRODUCT = "Change product 1 bug"
CHANGE_COMPONENT = "Change component 1 bug"
CHANGE_STATUS = "Change status 1 bug"
COMMENT_ONE = "Comment 1 bug"
PATCH_MERGED = "Having patch be merged"
ONE_IN_8_WEEKS = "1 in 8 weeks"
ONE_IN_4_WEEKS = "1 in 4 weeks"
FOUR_IN_4_WEEKS = "4 in 4 weeks"
EDIT_ONE_KB = "edit 1 article in KB"
L10N_ONE_KB = "l10n 1 KB article"
EDIT_N_KB = "edit {n} articles in kb"
L10N_N_KB = "l10n {n} KB articles"
N_FORUM_ANSWERS = "{n} answers on forum"
TRIAGE_N = "Help triage {n} bugs per quarter{suffix}"
# the four single actions a triage threshold counts
TRIAGE_SINGLE = (CHANGE_STATUS, COMMENT_ONE, CHANGE_PRODUCT, CHANGE_COMPONENT)
# bug-activity field names and values the rules test
FIELD_COMMENT = "comment"
FIELD_FLAGS = "flagtypes.name"
REVIEW_GRANTED = "review+"
HOSTING_PR_OPENED = "pull-request-opened"
HOSTING_COMMIT_AUTHOR = "commit-author"
SUPPORT_FORUM_ANSWER = "forum answer"
SUPPORT_KB = "kb"
SUPPORT_L10N = "localization"
ACTIVE_LEVEL = "active"
# the length to which support-site canonical lists are cut
CANONICAL_MAX_LEN = 65000


@dataclass(frozen=True)
class Names:
    """Deployment-specific names: sources, teams, product filters and URL prefixes."""

    bugs_source: str = "bugs"
    hosting_source: str = "hosting"
    reports_source: str = "reports"
    support_source: str = "support"
    reports_team: str = "Field reports"
    support_team: str = "Support"
    # "Filing a bug <product>" counts first reports on this product
    featured_product: str = "Featured product"
    bug_account_action: str = "Creating bug tracker account"
    support_account_action: str = "Creating support account"
    triage_suffix: str = ""
    bug_url: str = "https://bugs.example.org/show_bug.cgi?id="
    reports_url: str = "https://reports.example.org/u/"
    support_url: str = "https://support.example.org"

    @property
    def file_featured_bug(self) -> str:
        return f"{FILING_A_BUG} {self.featured_product}"

    def triage(self, n: int) -> str:
        return TRIAGE_N.format(n=n, suffix=self.triage_suffix)
