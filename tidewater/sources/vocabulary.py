"""Sentences the adapters build demo rows from: our own wording, chosen so that the rules'
keywords occur (alone, together and not at all). ``{name}`` places are filled per row."""

TICKET_SUBJECTS: dict[str, dict[str, list[str]]] = {
    "billing": {
        "en": ["Two lines on my invoice", "Card was charged again", "Where is my refund", "Renewal without notice"],
        "fr": ["Ma facture est double", "Paiement compté deux fois", "Où est mon remboursement", "Abonnement reconduit sans avis"],
    },
    "shipping": {
        "en": ["Nothing has arrived", "Box came damaged", "Tracking page is empty", "Delivery to the wrong door"],
        "fr": ["Livraison jamais venue", "Colis abîmé", "Suivi vide depuis lundi", "Encore un retard"],
    },
    "bug": {
        "en": ["Crash after the update", "Error when I save", "Filter is broken", "Page shows code 500"],
        "fr": ["Erreur à l'enregistrement", "Le filtre est cassé", "Tout plante après la mise à jour", "La page ne charge plus"],
    },
    "feature_request": {
        "en": ["Idea: weekly digest", "Please add shortcuts", "Is this on the roadmap?", "Missing feature in lists"],
        "fr": ["Idée pour la liste", "Ajouter des raccourcis", "Mode sombre un jour ?", "Petite demande"],
    },
    "account": {
        "en": ["Login loops forever", "New phone, no 2fa", "My password expired", "Close one account"],
        "fr": ["Connexion sans fin", "Nouveau téléphone, plus de 2fa", "Mot de passe expiré", "Fermer un compte"],
    },
    "other": {
        "en": ["Hello there", "Visiting your office", "For the newsletter", "Thank you"],
        "fr": ["Bonjour à tous", "Visite de vos bureaux", "Pour la lettre", "Merci beaucoup"],
    },
}
TICKET_DESCRIPTIONS: dict[str, dict[str, str]] = {
    "billing": {
        "en": "The payment page says {amt} while the confirmation says {exp}; I expect the second amount and am disappointed.",
        "fr": "La page indique {amt} euros et la confirmation {exp} euros ; je suis déçu et j'attends le second montant.",
    },
    "shipping": {
        "en": "Parcel {oid} was announced for {dt}. It is {delay} days later and the package is still somewhere.",
        "fr": "Le colis {oid} était annoncé pour le {dt}. Voici {delay} jours de plus et la livraison manque.",
    },
    "bug": {
        "en": "Since this morning the export fails with an error after ten seconds; our whole desk is blocked.",
        "fr": "Depuis ce matin l'export s'arrête sur une erreur au bout de dix secondes ; je suis furieux.",
    },
    "feature_request": {
        "en": "I love the product and would love a digest by mail. A small request, no hurry at all.",
        "fr": "J'adore le produit, ce serait super d'avoir un résumé par courriel. Rien ne presse.",
    },
    "account": {
        "en": "I cannot get in: the reset mail takes an hour and the link is dead by then. This is urgent.",
        "fr": "Je reste dehors : le courriel pour le mot de passe met une heure et le lien est mort.",
    },
    "other": {
        "en": "We will be in town on Friday and wondered whether somebody has time for a coffee.",
        "fr": "Nous passons vendredi et demandons si quelqu'un a le temps de prendre un café avec nous.",
    },
}
REVIEW_TITLES: dict[str, dict[str, list[str]]] = {
    "positive": {"en": ["Fast from day one", "The dashboard we wanted", "Helpful service", "Good value for teams"],
                 "fr": ["Rapide et clair", "Le prix est juste", "Une intégration sans peine", "Bon tableau de bord"]},
    "neutral": {"en": ["Does its job", "Setup took a week"], "fr": ["Fait le travail", "Mise en place longue"]},
    "negative": {"en": ["Too expensive for us", "One bug after another"], "fr": ["Trop cher pour nous", "Une erreur après l'autre"]},
}
LEAD_NOTES: dict[str, list[str]] = {
    "en": [
        "Spoke with {role} on the phone. Budget confirmed for Q3, so they move on from {comp}.",
        "Inbound from {src} page. Evaluating alternatives to {comp}; the demo is on Tuesday.",
        "Met at {src} booth: Large team of {sz} people in one building, annual deal wanted.",
        "Referred by existing customer, asks about migration. Needs SSO and the API first.",
        "Quiet call. Pricing objection at once, then nothing more. Nurture for next cycle.",
    ],
    "fr": [
        "Échangé avec le/la {role} au téléphone. Budget confirmé pour T3, adieu {comp}.",
        "Entrant via {src}, page des tarifs. Évalue des alternatives à {comp} ; démo mardi.",
        "Rencontré via {src}, stand voisin : Grande équipe de {sz} personnes, contrat annuel.",
        "Recommandé par un client existant, parle de migration. Besoin du SSO et de l'API d'abord.",
        "Appel bref. Objection sur le prix tout de suite. À cultiver pour le prochain cycle.",
    ],
}
LEAD_ROLES = ["buyer", "site manager", "founder", "data lead", "treasurer"]
LEAD_COMPETITORS = ["a spreadsheet", "an old tool", "paper forms", "two vendors", "a local firm", "nothing yet"]
LEAD_SIZES = ["7", "33", "150", "640", "12000", "75", "19", "3500000"]
