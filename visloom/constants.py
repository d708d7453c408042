"""Fixed values of the correlator domain."""

# Flag bits. The first three are configuration in principle; only their positions matter, in counts.
STATIC = 2
CAM = 4
DATA_LOST = 8
INGEST_RFI = 16
CAL_RFI = 64  # marks unflagged samples while averaging, so it never counts as a flag
COUNT_MASK = 255 - CAL_RFI

INT32_MIN = -2147483648  # real part of a sample whose data did not arrive
TIMESTAMP_BITS = 48
MIN_CHANNEL_WEIGHT = 2.0**-96
FLUSH_BELOW = 2e-9

# Defaults of a session.
RFI_WIDTH = 13
RFI_SIGMAS = 11.0
GUARD_CHANNELS = 64
MAD_TO_SIGMA = 1.4826
