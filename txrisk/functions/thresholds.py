"""Threshold grid of the sweep.

Fixed values: the 80 float64 thresholds of the reference sweep, i.e. the
values produced by an arange from 0.1 to 0.9 (exclusive) with step 0.01, in
ascending order, written exactly as their shortest round-trip decimal form.
They are carried literally because their rounding noise decides ties.
"""

THRESHOLDS = (
    0.1, 0.11, 0.12, 0.13, 0.13999999999999999, 0.14999999999999997, 0.15999999999999998,
    0.16999999999999998, 0.17999999999999997, 0.18999999999999995, 0.19999999999999996,
    0.20999999999999996, 0.21999999999999995, 0.22999999999999995, 0.23999999999999994,
    0.24999999999999992, 0.2599999999999999, 0.2699999999999999, 0.2799999999999999,
    0.2899999999999999, 0.29999999999999993, 0.30999999999999994, 0.3199999999999999,
    0.32999999999999985, 0.33999999999999986, 0.34999999999999987, 0.3599999999999999,
    0.3699999999999999, 0.3799999999999999, 0.3899999999999999, 0.3999999999999998,
    0.4099999999999998, 0.4199999999999998, 0.4299999999999998, 0.43999999999999984,
    0.44999999999999984, 0.45999999999999985, 0.46999999999999986, 0.47999999999999976,
    0.48999999999999977, 0.4999999999999998, 0.5099999999999998, 0.5199999999999998,
    0.5299999999999998, 0.5399999999999998, 0.5499999999999998, 0.5599999999999997,
    0.5699999999999997, 0.5799999999999997, 0.5899999999999997, 0.5999999999999998,
    0.6099999999999998, 0.6199999999999998, 0.6299999999999997, 0.6399999999999997,
    0.6499999999999997, 0.6599999999999997, 0.6699999999999997, 0.6799999999999997,
    0.6899999999999997, 0.6999999999999996, 0.7099999999999996, 0.7199999999999996,
    0.7299999999999996, 0.7399999999999997, 0.7499999999999997, 0.7599999999999997,
    0.7699999999999997, 0.7799999999999997, 0.7899999999999996, 0.7999999999999996,
    0.8099999999999996, 0.8199999999999996, 0.8299999999999996, 0.8399999999999996,
    0.8499999999999996, 0.8599999999999995, 0.8699999999999996, 0.8799999999999996,
    0.8899999999999996,
)

DEFAULT_THRESHOLD = 0.5
