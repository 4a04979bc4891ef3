"""Role names and tunables shared by all operators."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Roles:
    """Which column plays which role in the stay table.

    Nothing downstream hard-codes a column name; every operator takes a
    ``Roles`` (or explicit column arguments) instead.
    """

    subject: str = "subject_id"
    stay: str = "stay_id"
    time: str = "admit_time"
    label: str = "label"
    # columns never treated as features even when numeric
    protected: tuple[str, ...] = field(default=())

    def non_features(self) -> set[str]:
        return {self.subject, self.stay, self.time, self.label, *self.protected}


DEFAULT_ROLES = Roles()

# Fixed values used by the reference behaviour (kept as plain constants).
MISSING_THRESHOLD = 0.5      # strict "<" cut on the missing rate
TEST_SHARE_PERCENT = 20      # share of subjects in the test split
SMOTE_RATIO = 0.3            # minority / majority after over-sampling
SMOTE_K = 5                  # neighbours per minority row
SEED = 42
